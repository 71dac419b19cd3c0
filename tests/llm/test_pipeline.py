"""The pipeline stage by stage against plain computations over small tables."""

import random
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from stocklens.llm import mixing, packing, toxicity
from stocklens.llm.common import staged

WORDS, ALNUM = re.compile("[^\x20\x09-\x0D]+"), re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rnd = random.Random(11)
    vocabulary = ["".join(rnd.choice("aeioubdrstln") for _ in range(rnd.randrange(2, 8))) for _ in range(400)]
    prose = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    items = [" ".join(prose(n)) for n in (20, 30, 13)]
    texts, toxic = {}, {}
    for i in range(240):
        w = prose(rnd.randrange(30, 120))
        if i % 6 == 0:
            w[rnd.randrange(len(w)):0] = ["vilescum", "filthrot", "scumvermin"]
            toxic[i] = 1
        texts[i] = " ".join(w)
        toxic.setdefault(i, 0)
    for i in range(300, 320):  # copies, exact and near
        of = texts[i - 299].split()
        texts[i] = " ".join(of if i % 2 else [*of[:-1], "changed"])
    for i in range(400, 406):
        texts[i] = " ".join(prose(40)) + " " + items[i % 3].upper() + ". " + " ".join(prose(20))
    texts |= {500: None, 501: "", 502: " \n ", 503: "one", 504: "word " * 4000, 505: texts[7]}
    rows = [(i, t, "en", None if i % 7 == 0 else f"s{i % 3}", len(t or "")) for i, t in texts.items()]
    root = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, 1, t) for i, t in toxic.items()], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, items, toxic


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def shingles(text):
    w = WORDS.findall(lowered(text))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_first_of_groups(rows):
    sets, group = {r[0]: shingles(r[1]) for r in rows}, {r[0]: r[0] for r in rows}
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]) and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {k: low if v == high else v for k, v in group.items()}
    return [r for r in rows if group[r[0]] == r[0]]


def plain_clean(rows, items):
    windows = set()
    for t in items:
        w = ALNUM.findall(lowered(t))
        windows |= {tuple(w[i:i + 13]) for i in range(len(w) - 12)}
    out = []
    for r in rows:
        w = ALNUM.findall(lowered(r[1]))
        hit = {i + j for i in range(len(w) - 12) if tuple(w[i:i + 13]) in windows for j in range(13)}
        if not hit or 20 * len(hit) < len(w):
            out.append(r)
    return out


def decoded(packed):
    """Texts of packed rows, with how often each stands there; a document taken twice has its pieces twice."""
    encoder = packing.Encoder(packing.read_ranks())
    encoder("")
    whole = Counter()
    for r in packed.collect():
        ids, cu = np.frombuffer(r["ids"], "<u2"), r["cu_seqlens"]
        for k, (a, b) in enumerate(zip(cu, cu[1:])):
            if r["pieces"][k] == 0 and r["last"][k]:
                assert ids[b - 1] == encoder.end
                whole[r["doc_ids"][k], encoder.model.decode(ids[a:b - 1].tolist())] += 1
    return whole


def test_stages_and_run(spark, tables):
    root, items, toxic = tables
    docs = spark.read.parquet(f"{root}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_duplicates", "decontamination", "mixing", "packing"]

    clean = staged(stages["toxicity"](spark, docs, root), "test-toxicity")
    kept = {r["doc_id"] for r in clean.collect()}
    assert clean.columns == docs.columns and set(as_rows(clean)) <= set(as_rows(docs))
    wrong = [i for i, y in toxic.items() if (i in kept) == bool(y)]
    assert len(wrong) <= 0.05 * len(toxic)

    alone = staged(stages["near_duplicates"](spark, clean, root), "test-alone")
    assert as_rows(alone) == sorted(plain_first_of_groups(as_rows(clean)), key=str)
    pure = staged(stages["decontamination"](spark, alone, root), "test-pure")
    assert as_rows(pure) == sorted(plain_clean(as_rows(alone), items), key=str)
    assert not {400, 401, 402, 403, 404, 405} & {r["doc_id"] for r in pure.collect()}

    mixed = staged(stages["mixing"](spark, pure, root), "test-mixed")
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(pure).collect()}
    words = Counter()
    for r in mixed.collect():
        words[r["doc_id"]] += len(WORDS.findall(r["text"] or ""))
    assert mixed.columns == docs.columns and words == Counter({k: v for k, v in taken.items() if v})

    packed = stages["packing"](spark, mixed, root)
    short = Counter((r["doc_id"], r["text"] or "") for r in mixed.collect() if len(r["text"] or "") < 1500)
    got = decoded(packed)
    assert {k: got[k] for k in short} == dict(short) and set(packed.columns) == {c.split()[0] for c in packing.SCHEMA.split(", ")}

    whole = corpus_pipeline.run(spark, root)
    assert {k: v for k, v in decoded(whole).items() if k in short} == dict(short)


def test_empty_tables(spark, tables, tmp_path):
    root = tables[0]
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{root}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).isEmpty()


def test_no_labels_keeps_all(spark, tables):
    assert toxicity.fit(spark.read.parquet(f"{tables[0]}/documents.parquet"), spark.read.parquet(f"{tables[0]}/labels.parquet").limit(0)) is None
