"""Fill-in-the-middle against cuts counted unit by unit, and the exact way back."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stocklens.llm import fill_middle as fm

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")


def plain(text, doc_id, rate=90, spm=20):
    text = text or ""
    units = UNIT.findall(text)
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(d[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= rate:
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < spm else "psm"
    parts = ("<P>", prefix, "<S>", suffix) if form == "psm" else ("<S>", suffix, "<P>", prefix)
    return len(units), form, len(prefix), len(middle), "".join(parts) + "<M>" + middle


@settings(max_examples=300, deadline=None)
@given(st.text("abZ é€🙂\n<>PSM09", max_size=200), st.integers(1, 40), st.integers(1, 4))
def test_every_cut_of_a_text(text, block, strip):
    index, units = fm.BlockIndex(text.encode(), block, strip), UNIT.findall(text)
    assert (index.units, index.points) == (len(units), len(text))
    for k in range(len(units) + 2):
        before = "".join(units[:k])
        assert index.cut(k) == (len(before.encode()), len(before))


def test_tree_sums_after_changes():
    index = fm.BlockIndex(b"ab cd " * 100, 16, 2)
    index.add(3, 5, 7)
    sums = [0, 0]
    i = 4
    while i:
        sums = [s + int(x) for s, x in zip(sums, index.tree[i])]
        i -= i & -i
    units = len(UNIT.findall(("ab cd " * 100)[:64]))
    assert sums == [units + 5, 64 + 7]


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("rate, spm", [(90, 20), (100, 0), (100, 100), (0, 20)])
def test_forms_and_way_back(spark, rate, spm):
    texts = [None, "", "a", " ", "abc", "a<P>b", "<", "<S", "<M<S", ">x<", "é" * 50, "🙂 a" * 30, "word " * 40_000, "x" * 300_000, "<P" * 20, "\n\n a1b2",
             "ends with <", "tail <S"] * 6
    docs = [(None if i == 7 else i, t) for i, t in enumerate(texts)] + [(3, "again"), (3, "again")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("n", "form", "output")})
    made = fm.transform(frame, rate=rate, spm=spm)
    order = lambda r: (r[0] is None, r[0] or 0)
    got = sorted(rows(made), key=order)
    assert got == sorted(((i, *plain(t, i, rate, spm)) for i, t in docs), key=order)
    back = sorted(rows(made.select("doc_id", fm.restored(F.col("output"), F.col("form")))), key=order)
    assert back == sorted(((i, t or "") for i, t in docs), key=order)


def test_query_and_no_rows(spark, docs, empty, tmp_path):
    docs.write.parquet(f"{tmp_path}/a/documents.parquet")
    empty.write.parquet(f"{tmp_path}/b/documents.parquet")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for r in docs.collect():
        *head, output = plain(r["text"], r["doc_id"])
        want.append((r["doc_id"], *head, sha(output), sha(r["text"] or "")))
    assert sorted(rows(fm.query(spark, f"{tmp_path}/a")), key=str) == sorted(want, key=str)
    assert rows(fm.query(spark, f"{tmp_path}/b")) == []
