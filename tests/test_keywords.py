from docweave.operators import keywords as KW


def test_keywords_edge_cases(spark):
    rows = [
        (1, "éabc xyz1 a_bc abc"),  # only the free-standing 'abc' is a word
        (2, "beta alpha beta gamma alpha delta"),  # ties by first occurrence
        (3, "the and this"),  # stop words only
        (4, ""),
        (5, "Zeta zeta ZETA eta"),
        (6, None),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.keywords for r in KW.extract_keywords(df).collect()}
    assert got == {1: ["abc"], 2: ["beta", "alpha", "gamma", "delta"], 3: [], 4: [], 5: ["zeta", "eta"], 6: []}


def test_keyword_limit(spark):
    text = " ".join(f"w{chr(97 + i)}x" * (20 - i) for i in range(15))  # 15 distinct words, once each
    words = " ".join(" ".join([f"wo{chr(97 + i)}d"] * (20 - i)) for i in range(15))
    df = spark.createDataFrame([(1, words), (2, text)], "doc_id long, text string")
    got = {r.doc_id: r.keywords for r in KW.extract_keywords(df, max_keywords=10).collect()}
    assert got[1] == [f"wo{chr(97 + i)}d" for i in range(10)]
    assert got[2] == [f"w{chr(97 + i)}x" * (20 - i) for i in range(10)]  # all tie: first occurrence wins
