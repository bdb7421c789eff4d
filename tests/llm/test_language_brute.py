"""Language predictions against a plain recomputation, and the bounds of what is learned."""

import re
import unicodedata
import zlib

import zstandard
from pyspark.sql import functions as F

from driftwood.llm import language_id as li
from driftwood.llm import queries
from tests.conftest import SF_SMALL


def plain(text):
    kept = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in text.lower())
    return re.sub(" +", " ", kept).strip(" ")


def size(text, dictionary):
    """Bytes of a text, in blocks, after a raw-content dictionary."""
    params = zstandard.ZstdCompressionParameters.from_level(6, min_match=3, dict_size=len(dictionary), source_size=4096,
                                                            write_content_size=0, write_checksum=0, write_dict_id=0)
    raw = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    raw.precompute_compress(compression_params=params)
    data = text.encode()
    return sum(len(zstandard.ZstdCompressor(dict_data=raw, compression_params=params).compress(data[i:i + 4096]))
               for i in range(0, len(data), 4096))


def predicted(text, dictionaries):
    letters = plain(text or "")
    if not any(c.isalpha() for c in letters):
        return "und", 0.0, True
    sizes = {lang: size(letters, d) for lang, d in dictionaries.items()}
    best = min(sizes, key=lambda lang: (sizes[lang], lang))
    others = [s for lang, s in sizes.items() if lang != best]
    score = 1 / (1 + sum(2.0 ** (-min(s - sizes[best], 200) / 2) for s in others))
    margin = min(others) - sizes[best]
    return best, score, margin < 1 or margin < 0.005 * min(others)


def test_predictions_equal_a_plain_recomputation(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    learned = {}
    rows = [r for r in docs.values() if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 and r["lang"] is not None]
    for lang in sorted({r["lang"] for r in rows}):
        mine = [r for r in rows if r["lang"] == lang]
        assert len(mine) <= li.SAMPLE_ROWS                       # all of them are learned from
        learned[lang] = mine
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    dictionaries = li.learn(df, ~queries.held_out(), F.col("doc_id"))
    assert sorted(dictionaries) == sorted(learned)
    for lang, mine in learned.items():                            # the same texts, in an order of their own
        words = sorted(w for r in mine for w in plain(r["text"])[:li.SAMPLE_CHARS].split())
        got = dictionaries[lang].decode("utf-8", "ignore").split()
        assert len(dictionaries[lang]) <= li.DICTIONARY_BYTES and set(got[:-1]) <= set(words)
    out = queries.op2_language_id(spark, SF_SMALL).collect()
    assert len(out) == len(docs)
    for r in out:
        lang, score, rejected = predicted(docs[r["doc_id"]]["text"], dictionaries)
        assert (r["lang_pred"], r["rejected"]) == (lang, rejected) and abs(r["score"] - score) < 1e-12
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_length_changes_no_setting(spark):
    """A text just below and just above the old border is treated alike."""
    model = li.Classifier((("a", b"the quick brown fox jumps over the lazy dog " * 20), ("b", b"voix ambigue d un coeur qui au zephyr " * 20)))
    scores = [model.classify(("the lazy fox jumps " * 40)[:n])[1] for n in range(480, 540)]
    assert all(abs(x - y) < 0.2 for x, y in zip(scores, scores[1:])) and min(scores) > 0.9


def test_marks_stay_with_their_letters():
    assert li.letters("हिन्दी  123 ́e") == "हिन्दी ́e" and li.letters("a_b²c") == "a b c"


def test_many_labels_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(li, "MOST_LANGUAGES", 3)
    monkeypatch.setattr(li, "ALL_BYTES", 60)
    rows = [(f"l{i}", f"word{chr(97 + i)} " * 9) for i in range(6) for _ in range(6 - i)]
    got = li.learn(spark.createDataFrame(rows, "lang string, text string"), F.lit(True), F.col("text"))
    assert sorted(got) == ["l0", "l1", "l2"] and sum(map(len, got.values())) <= 60
