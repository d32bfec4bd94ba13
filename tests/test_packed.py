"""Splitting of packed fields against a reader of single characters."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexweave.operators import packed


def brute(text):
    """Read character by character: a quote at a value's start runs to the closing one before a delimiter or the end."""
    out, i, n = [], 0, len(text)
    blank = lambda c: c in "  "

    def delim(j):
        return text[j] in packed.HARD or (text[j] == "/" and 0 < j < n - 1 and blank(text[j - 1]) and blank(text[j + 1]))

    while i <= n:
        while i < n and blank(text[i]):
            i += 1
        if i >= n:
            break
        quoted = None
        if text[i] in packed.QUOTES:
            close, j, buf = packed.QUOTES[text[i]], i + 1, ""
            while j < n:
                if text[j] == close and text[j + 1 : j + 2] == close:
                    buf, j = buf + close, j + 2
                    continue
                if text[j] == close:
                    k = j + 1
                    while k < n and blank(text[k]):
                        k += 1
                    if k >= n or delim(k):
                        quoted = (buf, k + 1)
                        break
                buf, j = buf + text[j], j + 1
        if quoted:
            value, i = quoted
        else:
            j = i
            while j < n and not delim(j):
                j += 1
            value, i = text[i:j], j + 1
        if value.strip():
            out.append(value.strip())
    return out


def by_rule(text):
    import re

    runs = re.findall(f"{packed._ORDINARY}|[{packed._CLASS}]", text)
    skeleton = "".join("a" if re.fullmatch(packed._ORDINARY, r) else r for r in runs)
    out = []
    for first, n, mark in packed.split_rule(skeleton):
        v = "".join(runs[first : first + n])
        v = (v.replace(mark * 2, mark) if mark else v).strip()
        out += [v] if v else []
    return out


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet='ab=1 |,;\n\t/"“”-', max_size=24))
def test_rule_is_the_reader(text):
    assert by_rule(text) == brute(text)


def test_split(spark, rows):
    data = [
        (1, 'm=2|"R:Lexis; vol 2=2"|bor=1'), (1, 'm=2|"R:Lexis; vol 2=2"|bor=1'), (2, None), (3, ""), (4, " | |"), (5, 'a / b, "say ""thus"" form=1"\nc'),
        (6, "“Binutiz, Upper”, F'odebok, Upper-X a/b"), (7, 'open "quote | x'), (None, "a|b"), (8, "x|" * 3000),
    ]
    df = spark.createDataFrame(data, "id int, t string").withColumn("s", F.lit(1)).withColumn("rule", F.lit("clash")).withColumn("runs", F.lit(0))
    got = rows(packed.split_packed(df, F.col("id").cast("string"), F.col("t")))
    assert [g[1:] for g in got if g[0] == "1"] == [(1, "m=2"), (2, "R:Lexis; vol 2=2"), (3, "bor=1")]
    assert [g[2] for g in got if g[0] == "5"] == ["a", "b", 'say "thus" form=1', "c"]
    assert [g[2] for g in got if g[0] == "6"] == ["Binutiz, Upper", "F'odebok", "Upper-X a/b"]
    assert [g[2] for g in got if g[0] == "7"] == ['open "quote', "x"]
    assert sum(g[0] == "8" for g in got) == 3000
    assert {g[0] for g in got} == {"1", "5", "6", "7", "8"}


def test_salted_rules_agree(spark, rows, monkeypatch):
    df = spark.createDataFrame([(str(i), f"a{i}|b;c" + ";d" * (i % 3)) for i in range(60)], "k string, t string")
    want = rows(packed.split_packed(df, F.col("k"), F.col("t")))
    monkeypatch.setattr(packed, "BROADCAST_CHARS", 0)
    assert rows(packed.split_packed(df, F.col("k"), F.col("t"))) == want


def test_empty_table(spark):
    assert packed.split_packed(spark.createDataFrame([], "k string, t string"), F.col("k"), F.col("t")).count() == 0
