"""Rows judged without their texts are those that mix judges with them."""

from collections import Counter

from merchweave.llm import mixing


def test_judge_equals_mix(spark):
    rows = [(i, None if i % 7 == 0 else f"word {i} " * (i % 130), f"s{i % 3}", "en" if i % 4 else None) for i in range(300)]
    docs = spark.createDataFrame([*rows, rows[3], (None, "copyright", "s1", "en")], "doc_id long, text string, source string, lang string")
    names = ["doc_id", "source", "lang", "__topic", "__tokens", "__probability", "__kept"]
    with_texts, without = mixing.mix(docs), mixing.judge(docs)
    assert "text" in with_texts.columns and "text" not in without.columns

    def found(df):
        return Counter(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(*names).collect())

    assert found(with_texts) == found(without)
