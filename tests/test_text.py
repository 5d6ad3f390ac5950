import re

from pyspark.sql import functions as F

from millrace.functions import text as X

SPACES = [chr(c) for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def clean(t):
    return re.sub(r"[^\S\n]+", " ", re.sub(r"\n{3,}", "\n\n", t.strip()))


def marker(t):
    t = t.rstrip()
    return t[: -len(X.END_MARKER)].rstrip() if t.endswith(X.END_MARKER) else t


TEXTS = ["", " ", "a", " a \r\n b ", "a\n\n\n\nb", "a\n \n \nb", "x<|endoftext|>", "x <|endoftext|> \n", "<|endoftext|><|endoftext|>", "ğ😀  ş", "a\n", *[f"{s}a{s}{s}b{s}" for s in SPACES], "a​b", "long " * 20000]


def test_cleaning_agrees_with_python(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS, None])], "i int, t string")
    got = {r.i: r for r in rows.select("i", X.clean_text(F.col("t")).alias("c"), X.strip_end_marker(F.col("t")).alias("m"), X.is_blank(F.col("t")).alias("b"), X.n_chars(F.col("t")).alias("n"), X.n_bytes(F.col("t")).alias("o")).collect()}
    for i, t in enumerate(TEXTS):
        assert got[i].c == clean(t), repr(t[:40])
        assert got[i].m == marker(t), repr(t[:40])
        assert got[i].b == (not t.strip())
        assert (got[i].n, got[i].o) == (len(t), len(t.encode()))
    null = got[len(TEXTS)]
    assert null.c is None and null.m is None and null.b and null.n is None


def test_scores(spark):
    rows = spark.createDataFrame([(0, "4.7"), (1, " 4.0 "), (2, "bad"), (3, None), (4, "NaN"), (5, "-1"), (6, None)], "i int, s string").withColumn("absent", F.col("i") == 6)

    def kept(least, **more):
        return {r.i for r in rows.filter(X.score_at_least(F.col("s"), least, F.col("absent"), **more)).collect()}

    assert kept(4.0) == {0, 1}
    assert kept(0.0) == {0, 1, 6}
    assert kept(0.0, unreadable=0.0) == {0, 1, 2, 3, 6}


def test_sizes_and_globs(spark):
    assert X.gigabytes(1.5) == 3 * 2**29 and X.estimated_tokens(1) == 2**28
    rows = spark.createDataFrame([("p_1/a_1.jsonl.gz",), ("p_1/b.txt",), ("deep/p_1/a_1.jsonl.gz",)], "p string")
    assert {r.p for r in rows.filter(X.path_matches(F.col("p"), "p_*/a_*.jsonl.gz")).collect()} == {"p_1/a_1.jsonl.gz"}
    assert {r.p for r in rows.filter(X.path_matches(F.col("p"), "*.txt")).collect()} == {"p_1/b.txt"}


def test_chat(spark):
    rows = spark.createDataFrame([("user", "hi"), ("tool", "x")], "r string, c string").select(X.chat_turn(F.col("r"), F.col("c")).alias("t")).collect()
    assert [r.t for r in rows] == ["<|im_start|>user\nhi<|im_end|>\n", None]
