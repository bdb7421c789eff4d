from driftwood.llm import decontamination


def test_items_without_id_hit(spark):
    long, short = " ".join(f"w{i}" for i in range(20)), "three short words"
    docs = spark.createDataFrame([(1, long), (2, f"see {short}"), (3, "nothing of it"), (4, "both " + long + " seen too")],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(None, long), (None, short), (7, " ".join(f"w{i}" for i in range(13)))],
                                  "item_id long, text string")
    got = {r["doc_id"]: (r["n_hit"], r["items"], r["n_items"], r["contaminated"])
           for r in decontamination.decontaminate(docs, items).collect()}
    assert got == {1: (20, ["7"], 1, True), 2: (3, [], 0, True), 3: (0, [], 0, False), 4: (20, ["7"], 1, True)}
    assert [r["doc_id"] for r in decontamination.drop_contaminated(docs, items).collect()] == [3]
