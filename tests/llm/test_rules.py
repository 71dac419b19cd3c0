"""Quality rules against counts made word by word."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from stocklens.llm import rules

WORD = re.compile("[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    met = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if met[w] > 1 for j in range(8)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_marks": sum(c in "!?" for c in text), "n_letter_words": sum(any(c.isalpha() for c in w) for w in words),
            "n_stop_words": sum(w.lower() in rules.STOP_WORDS for w in words), "n_lines": len(lines),
            "n_dup_lines": len(lines) - len(set(lines)), "n_bullet_lines": sum(x.lstrip(" \t")[:1] in ("-", "*", "•") for x in lines),
            "n_cut_lines": sum(x.rstrip(" \t\r").endswith(("...", "…")) for x in lines), "n_repeat_words": len(covered)}


def plain_failed(m):
    out = []
    for r in rules.RULES:
        part, whole = m[r.part], m[r.whole]
        if (r.low is not None and (part + r.slack) * 1000 < r.low * whole) or (r.high is not None and (part - r.slack) * 1000 > r.high * whole):
            out.append(r.name)
    return out


def check(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    own = [rules.measure(n).alias(n) for n in [*rules.MEASURES, "base_failed", "failed", "kept"]]
    for r in rules.judged(frame).select("doc_id", *own).collect():
        want = plain(texts[r["doc_id"]])
        assert {n: r[n] for n in rules.MEASURES} == want, texts[r["doc_id"]]
        base = want["n_words"] < 20 or 100 * want["n_repeat_words"] > 30 * want["n_words"]
        assert r["base_failed"] == base and r["failed"] == plain_failed(want) and r["kept"] == (not base and not r["failed"])


def test_awkward_texts(spark):
    loop = "one two three four five six seven eight "
    check(spark, [None, "", " \n\t\r ", "one", loop.strip(), loop * 2, loop + "nine " + loop, "a " * 5000, "x y " * 40, loop * 3 + "end of it",
                  "- a\n* b\n• c\n\t- d", "cut...\ncut…  \r\nnot cut. ..\nline", "same\nsame\r\nsame \nsame", "a\x0bb\x0cc\x1cd\x85e f g",
                  "## $$ | <b> & 100% #*$%&|<>", "Über straße NAÏVE ÇA 123 4.5 ½ 漢字 🙂", "word!! " * 30, "the of and " * 10, "long " + "y" * 300_000,
                  loop * 20 + " ".join(f"w{i}" for i in range(30_000)) + loop])


def test_any_text(spark):
    rnd = random.Random(6)
    check(spark, ["".join(rnd.choice("ab \n\t\r!#-.é…") for _ in range(rnd.randrange(160))) for _ in range(400)])


def test_thresholds_and_kept_rows(spark, docs, empty):
    rnd = random.Random(4)
    clean = " ".join(rnd.choice(["the", "house", "of", "mine", "stands", "and", "river", "flows"]) + rnd.choice(["", ","]) for _ in range(200))
    rows = [(1, clean), (2, clean.upper().replace(" ", "!! ")), (3, " | ".join(WORD.findall(clean))), (4, (clean[:60] + "\n") * 40), (5, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"words": F.lit(1), "n_words": F.lit("x"), "lines": F.lit(2.0)})
    kept = rules.kept_rows(frame)
    assert kept.columns == frame.columns and [r["doc_id"] for r in kept.collect()] == [1]
    assert rules.kept_rows(docs).columns == docs.columns and rules.kept_rows(docs).isEmpty()
    assert rules.kept_rows(empty).isEmpty()
    assert [r["doc_id"] for r in rules.kept_rows(frame, []).collect()] == [1, 2, 3]


def test_no_python_and_no_shuffle(spark, tmp_path, docs):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    plan = rules.query(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Python", "Arrow", "Pandas"))
    assert plan.count("split(") == 2 and plan.count("sort_array(transform(") == 2  # each array is made once
