"""Each operator on awkward rows against a plain computation of the same."""

import gzip
import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stocklens.llm import chat, decontaminate, fingerprint, language_model, mixing, neardup, packing, quality, toxicity, warc
from stocklens.llm.common import components, new_folder, staged

BLANK_WORDS = re.compile("[^\x20\x09-\x0D]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_words(text):
    return BLANK_WORDS.findall(low(text))


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def test_components_are_smallest_reachable(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    for node, component in got.items():
        seen, todo = {node}, [node]
        while todo:
            todo += [n for n in near[todo.pop()] - seen if not seen.add(n)]
        assert component == min(seen)
    assert set(got) == {n for e in edges if e[0] != e[1] for n in e}


def plain_targets(sizes):
    names = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(2 * sizes[s] for s in capped)
        level = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in capped else weight[s] * level for s in names}
        capped |= over


def test_mixing_meets_targets(spark, docs, empty):
    got = rows(mixing.mix(docs))
    sizes = Counter()
    for r in docs.collect():
        sizes[r["source"]] += len(BLANK_WORDS.findall(r["text"] or ""))
    want = plain_targets(sizes)
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert len(got) == docs.count() and all(abs(taken[s] - want[s]) <= 8 for s in sizes)
    key = lambda r: (r["doc_id"], r["taken"])
    assert sorted(got, key=key) == sorted(rows(mixing.mix(docs.repartition(3))), key=key)
    mixed = mixing.mixed_texts(docs)
    assert mixed.columns == docs.columns
    assert sum(len(plain_words(r["text"])) for r in mixed.collect()) == sum(taken.values())
    assert rows(mixing.mix(empty)) == []


def test_sainte_lague_equals_seat_by_seat(spark):
    votes = {"a": 53, "b": 24, "c": 23, "d": 1, "e": 0, "f": 24}
    seats, won = 17, Counter()
    for _ in range(seats):
        won[max(sorted(votes), key=lambda s: votes[s] / (2 * won[s] + 1))] += 1
    got = mixing.sainte_lague(spark.createDataFrame(list(votes.items()), "s string, v long"), "v", F.lit(seats), ["s"], "test").collect()
    assert {r["s"]: r["quota"] for r in got} == {s: won[s] for s in votes}


def test_quality_learns_and_scores_empty_texts(spark, docs, empty):
    rnd = random.Random(2)
    good = [(i, " ".join("abcdefghij"[rnd.randrange(10)] * rnd.randrange(2, 7) for _ in range(60))) for i in range(80)]
    bad = [(100 + i, "$$$ BUY!! " * rnd.randrange(20, 60)) for i in range(80)]
    stats = quality.document_statistics(spark.createDataFrame(good + bad, "doc_id long, text string"))
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(None, 1)], "doc_id long, quality int")
    model = quality.fit(stats, labels)
    assert all(r["predicted"] == (r["doc_id"] < 100) for r in quality.score(stats, model).collect())
    assert quality.score(quality.document_statistics(docs), model).where("score between 0 and 1").count() == docs.count()
    assert {r["score"] for r in quality.score(stats, quality.fit(stats, labels.limit(0))).collect()} == {0.5}
    assert quality.score(quality.document_statistics(empty), model).isEmpty()


def test_warc_round_trip(spark):
    long = "é<p>WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 60
    pages = [(1, "http://a.example/x y", long), (5, None, long), (3, "http://b.example", long), (7, "u", None), (8, "u", ""), (9, "u", "short"),
             (10, "http://c.example/\r\nX: 1", "short"), (1, "http://a.example/x y", long)]
    path = new_folder(spark, "test-warc")
    warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string"), path, file_records=4)
    assert warc.opened(gzip.compress(b"WARC/1.1 a") + gzip.compress(b"b")).read() == b"WARC/1.1 ab" and warc.opened(b"WARC/1.1 a").read() == b"WARC/1.1 a"
    got = {r["metadata"]["page_id"]: r for r in rows(warc.captures(warc.read_archives(spark, path)))}
    assert set(got) == {p[0] for p in pages}
    for page_id, _, html in pages:
        answer, data = got[page_id]["response"], (html or "").encode()
        again = html == long and page_id != 5
        assert (answer["payload_bytes"], answer["digest"]) == (len(data), hashlib.sha1(data).hexdigest())
        assert (answer["type"], answer["refers_to_page"]) == (("revisit", 5) if again else ("response", None))
        assert again or bytes(answer["payload"]) == data
        assert got[page_id]["request"]["http"].startswith("GET ") and answer["intact"]


def test_warc_repeated_rows_clashing_columns_and_no_rows(spark):
    """As many captures as rows, with identifiers of their own; revisits point at a capture that is there."""
    body = "<p>same</p>" * 200
    pages = ([(1, "u", body)] * 3 + [(2, "u", body)] * 2 + [(None, None, body)] * 2 + [(3, "u", "short")] * 4 + [(3, "v", "short"), (4, None, None)] * 2
             + [(6, "", "x"), (6, None, "x")])
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"digest": F.lit("d"), "key": F.lit(1), "_n": F.lit(2)})
    path = new_folder(spark, "test-warc")
    warc.write_archives(df, path)
    got = rows(warc.captures(warc.read_archives(spark, path)))
    assert Counter(r["metadata"]["page_id"] for r in got) == Counter(p[0] for p in pages)
    ids = {r["capture_id"] for r in got}
    assert len(ids) == len(pages) and all(r["request"] and r["metadata"] and r["response"]["intact"] for r in got)
    for r in got:
        again = r["metadata"]["page_id"] == 1
        assert (r["response"]["type"], r["response"]["refers_to_page"]) == (("revisit", 2) if again else ("response", None))
        assert not again or r["response"]["refers_to"] in ids
    path = new_folder(spark, "test-warc")
    warc.write_archives(df.limit(0), path)
    assert warc.captures(warc.read_archives(spark, path)).isEmpty()


def shingle_set(text, size):
    w = plain_words(text)
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def plain_components(texts, size, percent):
    sets = {i: shingle_set(t, size) for i, t in texts.items()}
    comp = {i: i for i in texts}
    for _ in texts:
        for a in texts:
            for b in texts:
                common = len(sets[a] & sets[b])
                if common and 100 * common >= percent * len(sets[a] | sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
    return {i: (len(sets[i]), comp[i]) for i in texts}


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_duplicates_against_all_pairs(spark, docs, empty, size, percent):
    rnd = random.Random(size)
    base = [[f"w{rnd.randrange(400)}" for _ in range(90)] for _ in range(4)]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for i in range(48):  # chains of edits, many near the threshold
        words = list(base[i % 4])
        for _ in range(rnd.randrange(7)):
            words[rnd.randrange(90)] = f"e{rnd.randrange(9999)}"
        texts[100 + i] = " ".join(words)
    df = spark.createDataFrame([*texts.items(), (None, "no id"), (9, texts[9])], "doc_id long, text string")
    got = rows(neardup.near_duplicates(df, percent, size))
    want = plain_components(texts, size, percent)
    assert len(got) == df.count()
    for r in got:
        if r["doc_id"] is None:
            assert r["kept"] and r["component_id"] is None
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"])
    assert neardup.near_duplicates(empty).isEmpty()
    kept = [r["doc_id"] for r in neardup.without_duplicates(df, percent, size).collect()]
    assert len(kept) == len(set(kept)) and set(kept) - {None} == {i for i, (_, c) in want.items() if i == c}


def test_rows_with_equal_ids_are_told_apart_by_text(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    table = [(1, a), (1, b), (1, b), (2, a + " more"), (3, c), (3, None), (3, ""), (None, a), (None, a)]
    df = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(table)], "doc_id long, text string, _rank int")
    kept = Counter((r["doc_id"], r["text"]) for r in neardup.without_duplicates(df).collect())
    # Digests order rows within an id; the empty text and the null one have no shingles and are one identity each.
    assert kept[1, a] == kept[1, b] == kept[3, c] == 1 and (2, a + " more") not in kept and kept[None, a] == 2
    assert kept[3, None] == kept[3, ""] == 1 and kept.total() == 7
    assert neardup.without_duplicates(df).columns == df.columns


def test_near_duplicates_lose_no_more_than_stated(spark, monkeypatch):
    from math import comb

    for percent in (80, 85):
        t, n = percent / 100, neardup.bands_for(percent)
        k, p = n * neardup.ROWS, t + (1 - t) / 4
        least = neardup.lowest_estimate(percent, k)
        assert (1 - t ** neardup.ROWS) ** n <= 1e-6
        assert sum(comb(k, i) * p ** i * (1 - p) ** (k - i) for i in range(k + 1) if (i / k - 0.25) / 0.75 < least) <= 1e-6
    # A link that the estimate drops is found by the exact prefix join.
    monkeypatch.setattr(neardup, "estimate", lambda *_: F.lit(0.0))
    text = [f"w{i}" for i in range(90)]
    df = spark.createDataFrame([(1, " ".join(text)), (2, " ".join([*text, "x"])), (3, "of its own kind and more")], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in rows(neardup.near_duplicates(df, 80, 5))} == {1: 1, 2: 1, 3: 3}


def test_language_model_counts_base_and_probability(spark, docs, empty):
    learn = F.col("doc_id") != 10
    got = {r["doc_id"]: r for r in rows(language_model.score_texts(docs, learn, chunk_chars=3000))}
    train = Counter()
    for r in docs.where(learn).collect():
        train.update([*plain_words(r["text"]), "\n"])
    n, v = sum(train.values()), len(train)
    for r in docs.collect():
        t, g = [*plain_words(r["text"]), "\n"], got[r["doc_id"]]
        assert (g["n_tokens"], g["n_known"], g["train_tokens"]) == (len(t), sum(train[w] > 0 for w in t), n)
        assert abs(g["base_score"] - sum(np.log10((train[w] + 1) / (n + v + 1)) for w in t)) < 1e-6 * len(t) and g["score"] < 0
    whole = {r["doc_id"]: r["score"] for r in language_model.score_texts(docs, learn).collect()}
    assert all(abs(whole[i] - g["score"]) < 1e-6 * (1 + abs(whole[i])) for i, g in got.items())
    assert language_model.score_texts(empty, learn).isEmpty()


def test_byte_predictions_sum_to_one():
    rng = np.random.default_rng(3)
    seen = np.unique(rng.integers(97, 101, (60, 3)) @ np.array([1, 256, 65536]))
    context = int(seen[0]) >> 8
    every = np.concatenate([seen, (context << 8) | np.arange(256)])
    n = np.append(rng.integers(0, 4, len(seen)), np.zeros(256)).astype(float)
    x, total = language_model.Levels(every, n), np.ones(len(every))
    frames = []
    for bit in range(8):
        x.bit(bit)
        for i, f in enumerate(x.first):
            frames.append((int(x.context[f]) & 255, int(x.node[f]), x.zeros[i], x.ones[i], x.log_w[i]))
    merged = defaultdict(lambda: np.zeros(3))
    for byte, node, *values in frames:
        merged[byte, node] += values
    top = language_model.Top([type("Row", (), dict(byte=k[0], node=k[1], zeros=v[0], ones=v[1], below=v[2])) for k, v in merged.items()])
    for bit in range(8):
        x.bit(bit)
        total *= top.finish(x)
    assert abs(total[len(seen):].sum() - 1) < 1e-9


def test_contexts_run_across_words_at_full_depth(spark):
    text = "ab cde fghij kl"
    whole = bytes(6) + b"\n" + text.encode() + b" \n"
    for size in (1 << 20, 4):
        got = [(int(i), int(k) & (1 << 64) - 1) for t, key in language_model.running([text.encode(), None], size) for i, k in zip(t, key)]
        assert got[:-1] == [(0, int.from_bytes(whole[j - 7:j + 1], "big")) for j in range(7, len(whole))]
        assert got[-1] == (1, 10 << 8 | 10)
    # Only the words before tell which ending follows.
    learnt = [(i, "red fox ran " if i % 2 else "old cat sat ") for i in range(60)]
    df = spark.createDataFrame([(i, t * 3) for i, t in learnt] + [(100, "red fox ran"), (101, "red fox sat")], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in rows(language_model.score_texts(df, F.col("doc_id") < 100))}
    assert got[100] > got[101] + 1.5


def test_language_model_against_a_recursion_over_contexts(spark):
    texts = {1: "abab cab  BA", 2: None, 3: "abc abd\u00e9", 4: "cab", 5: "zz abab", 6: "abab cab ba"}
    count = Counter()
    def steps(text):
        coded = b"".join(w.encode() + b" " for w in plain_words(text)) + b"\n"
        whole = bytes(6) + b"\n" + coded
        return [(whole[j - 7:j], whole[j]) for j in range(7, len(whole))]
    for i, t in texts.items():
        if i < 4:
            count.update((c[7 - d:], y >> 7 - b, 1 << b | y >> 8 - b) for c, y in steps(t) for d in range(8) for b in range(8))
    longer = defaultdict(set)
    for c, bits, node in count:
        if c:
            longer[c[1:], node].add(c)

    def kt(c, node):
        zeros, ones = (count[c, (node << 1 | x) - (2 << node.bit_length() - 1), node] for x in (0, 1))
        p = 1.0
        for k, (x, n) in enumerate([(0, zeros), (1, ones)]):
            for i in range(n):
                p *= (i + 0.5) / (i + 1 + (zeros if k else 0))
        return p, zeros, ones

    def below(c, node):
        return float(np.prod([weighted(x, node) for x in longer[c, node]]))

    def weighted(c, node):
        return kt(c, node)[0] if len(c) == 7 else (kt(c, node)[0] + below(c, node)) / 2

    def predict(c, d, node, bit):
        own, zeros, ones = kt(c[7 - d:], node)
        p = ((ones if bit else zeros) + 0.5) / (zeros + ones + 1)
        if d == 7 or sum(kt(c[6 - d:], node)[1:]) == 0:
            return p
        deeper = below(c[7 - d:], node)
        return (own * p + deeper * predict(c, d + 1, node, bit)) / (own + deeper)

    want = {i: sum(np.log10(predict(c, 0, 1 << b | y >> 8 - b, y >> 7 - b & 1)) for c, y in steps(t) for b in range(8)) for i, t in texts.items()}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for chars in (5, 1000):
        got = {r["doc_id"]: r["score"] for r in rows(language_model.score_texts(df, F.col("doc_id") < 4, chars))}
        assert all(abs(got[i] - w) < 1e-5 * abs(w) for i, w in want.items()), (got, want)


def test_packed_numbers_round_trip():
    for x in (np.array([0, 1, 1, 2**63 + 5, 2**64 - 1], np.uint64), np.zeros(0, np.uint64), np.arange(3, dtype=np.uint64) << np.uint64(40)):
        assert (language_model.unsqueezed_rising(language_model.squeezed_rising(x)) == x).all()
    y = np.array([-1.5, 0, 3.25], np.float32)
    assert (language_model.unsqueezed(language_model.squeezed(y), np.float32) == y).all()


def test_log_kt_is_the_sequential_product():
    p, counts = 1.0, [0, 0]
    for bit in (0, 1, 1, 0, 1, 1, 1):
        p *= (counts[bit] + 0.5) / (sum(counts) + 1)
        counts[bit] += 1
    assert abs(language_model.log_kt(np.array([counts[0]]), np.array([counts[1]]))[0] - np.log(p)) < 1e-10


def test_chat_round_trip(spark):
    hard = r"\### Assistant: </turn> ok <turn>\b\l\n" + "\nx"
    rnd = random.Random(4)
    table = [(c, t, rnd.choice(["user", "assistant"]), rnd.choice([hard, None, "", "a b c " * rnd.randrange(120)])) for c in range(6) for t in range(30)]
    table += [(0, -1, "system", "be kind # <"), (None, 0, "assistant", "x"), (7, 1, None, "no role"), (7, 1, None, "no role"), (8, None, "a\nb", hard)]
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    windows = chat.format_chat(df, budget=100, history=20)
    got = {r["conv_id"]: r for r in rows(chat.digests(windows))}
    talks = defaultdict(list)
    for c, t, role, text in table:
        talks[c].append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(talks)
    for c, turns in talks.items():
        turns.sort()
        loss = "".join(x for _, _, role, x in turns if role == "assistant")
        assert got[c]["n_turns"] == len(turns) and got[c]["loss_chars"] == len(loss)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, _, r, x in turns).encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    zero = windows.where("conv_id = 0").collect()
    assert len(zero) > 1 and all(w["formatted"].startswith("<turn>system\n") for w in zero)
    assert chat.digests(chat.format_chat(df.limit(0))).isEmpty()


def plain_windows(turns, budget, history, segment):
    """(first, history start, last) of each window by a plain walk over (role, text) turns, and the tokens before each."""
    size = [len(BLANK_WORDS.findall(x)) + 1 for _, x in turns]
    before = [sum(size[:i]) for i in range(len(size))]
    lead = bool(turns) and turns[0][0] == "system"
    out, i = [], 0
    while i < len(turns):
        room = max(budget - (size[0] if lead else 0), budget // 4) if i else budget
        h = i
        while h > int(lead) and before[i] - before[h - 1] <= min(history, room - size[i]):
            h -= 1
        last = i
        while (last + 1 < len(turns) and before[last + 1] // (segment * budget) == before[i] // (segment * budget)
               and before[last + 1] + size[last + 1] - before[h] <= room):
            last += 1
        out.append((i, h, last))
        i = last + 1
    return out, size


@pytest.mark.parametrize("segment", [2, 32])
def test_chat_windows_keep_the_budget(spark, segment):
    """Longest runs by a plain walk; above the budget are single turns longer than the room, and long system turns, only."""
    budget, history = 60, 15
    rnd = random.Random(6)
    talks = {c: [(rnd.choice(["user", "assistant"]), "w " * rnd.choice([0, 1, 3, 10, 25, 44, 59, 60, 200])) for _ in range(rnd.choice([1, 9, 120]))]
             for c in range(14)}
    for c, n in ((1, 5), (2, 30), (3, 58), (4, 300), (5, 0)):
        talks[c].insert(0, ("system", "s " * n))
    df = spark.createDataFrame([(c, t, r, x) for c, turns in talks.items() for t, (r, x) in enumerate(turns)],
                               "conv_id long, turn long, role string, text string").withColumns({"window": F.lit(1), "_n": F.lit(2)})
    got = defaultdict(list)
    for w in chat.format_chat(df, budget, history, segment).collect():
        got[w["conv_id"]].append(w)
    for c, turns in talks.items():
        want, size = plain_windows(turns, budget, history, segment)
        mine = sorted(got[c], key=lambda w: w["first_turn"])
        system = turns[0][0] == "system"
        assert [w["first_turn"] for w in mine] == [first for first, _, _ in want]
        for w, (first, back, last) in zip(mine, want):
            held = ([0] if system and first else []) + list(range(back, last + 1))
            assert w["formatted"] == "".join(f"<turn>{turns[i][0]}\n{turns[i][1]}</turn>\n" for i in held)
            assert w["repeated"] == [i < first for i in held] and w["n_turns"] == len(held)
            assert w["n_tokens"] == sum(size[i] for i in held)
            long_system = system and size[0] > 3 * budget // 4
            assert w["n_tokens"] <= budget or long_system or (back == first == last)


def test_toxicity_gradient_and_learning(spark, docs, empty):
    rnd = random.Random(5)
    words = ["".join(rnd.choice("aeioust") for _ in range(5)) for _ in range(200)]
    def text(bad):
        w = [rnd.choice(words) for _ in range(rnd.randrange(5, 90))]
        if bad:
            w[rnd.randrange(len(w))] = "vile" + rnd.choice(words)
        return " ".join(w).encode()
    y = np.array([i % 2 for i in range(400)])
    net = toxicity.train([text(v) for v in y], y)
    fresh = np.array([i % 2 for i in range(120)])
    assert ((net([text(v) for v in fresh]) >= 0.5) == fresh).mean() > 0.9
    assert toxicity.score(docs, net).where("score between 0 and 1").count() == docs.count() and toxicity.score(empty, net).isEmpty()
    kept = toxicity.without_toxic(docs, net)
    assert kept.columns == docs.columns and kept.count() == toxicity.score(docs, net).where("predicted = 0").count()
    assert toxicity.train([b"a"], np.array([1])) is None
    counts = np.array([0, 1, 32, 33, 500])
    owner, start = toxicity.windows(counts)
    for i, n in enumerate(counts):
        mine = start[owner == i]
        assert mine[0] == 0 and mine[-1] + toxicity.WINDOW >= n and (len(mine) == 1 or mine[-1] < n)


@pytest.mark.parametrize("filter_bits, candidates", [(1 << 20, 1000), (64, 3)])
def test_contamination_against_plain_windows(spark, docs, empty, monkeypatch, filter_bits, candidates):
    """Alike with a filter that lets nearly all positions through."""
    monkeypatch.setattr(decontaminate, "CANDIDATES", candidates)
    rnd = random.Random(6)
    vocabulary = [f"v{i}" for i in range(12)]
    items = {i: " ".join(rnd.choice(vocabulary) for _ in range(n)) for i, n in enumerate((20, 13, 15, 4, 1))} | {50: "", 51: None, 52: "Über-Straße!"}
    texts = {200 + i: " ".join(rnd.choice(vocabulary) for _ in range(40)) + " ," + (items[i % 3] or "").upper() + "; tail" for i in range(12)}
    texts |= {r["doc_id"]: r["text"] for r in docs.collect()} | {300: "the über STRASSE über straße", 301: items[0]}
    benchmark = spark.createDataFrame([*items.items(), (0, items[0]), (None, "v1 v2")], "item_id long, text string")
    def tokens(t):
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low(t))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in rows(decontaminate.verdicts(decontaminate.contamination(df, benchmark, filter_bits=filter_bits)))}
    assert set(got) == set(texts)
    for i, t in texts.items():
        w, hit, found = tokens(t), set(), set()
        for item, other in items.items():
            o = tokens(other)
            n = min(13, len(o))
            for k in range(len(o) - n + 1 if o else 0):
                for p in range(len(w) - n + 1):
                    if w[p:p + n] == o[k:k + n]:
                        hit |= set(range(p, p + n))
                        found.add(str(item))
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["n_items"]) == (len(w), len(hit), len(found))
        assert got[i]["items_sha256"] == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert got[i]["contaminated"] == (bool(hit) and 20 * len(hit) >= len(w))
    bad = {i for i, r in got.items() if r["contaminated"]}
    wide = df.unionAll(df.limit(1)).withColumns({"n_words": F.lit(1), "text_hash": F.lit("x"), "_id": F.col("doc_id"), "win": F.lit(0)})
    kept = decontaminate.without_contaminated(wide, benchmark.withColumn("doc_id", F.lit(1)), filter_bits=filter_bits)
    assert bad and kept.columns == wide.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in wide.collect() if r["doc_id"] not in bad)
    assert decontaminate.contamination(empty, benchmark).isEmpty()
    assert decontaminate.contamination(df, benchmark.limit(0)).where("size(spans) > 0").isEmpty()


def test_contamination_candidates_are_windows_that_occur(spark, monkeypatch):
    """Documents that hold every pair of a window's words, but not the window, give no candidate."""
    kept = {}
    monkeypatch.setattr(decontaminate, "staged", lambda df, name: kept.setdefault(name, staged(df, name)))
    words = [f"w{i}" for i in range(14)]
    pairs = [(i, f"head {words[i % 13]} {words[i % 13 + 1]} tail") for i in range(130)]
    df = spark.createDataFrame([*pairs, (200, "so " + " ".join(words) + " it is")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in rows(decontaminate.contamination(df, benchmark)) if r["spans"]}
    assert got == {200: [{"start": 1, "end": 15}]}
    assert kept["candidates"].select("doc_id", F.explode("found")).count() == 2


def test_language_model_counts_contexts_without_texts(monkeypatch):
    """A chunk's contexts against a plain count; sorting them carries no text numbers along."""
    monkeypatch.setattr(language_model, "sorted_runs", None)
    rnd = random.Random(11)
    texts = [" ".join(rnd.choice(["ab", "Abc", "ü", "x"]) for _ in range(rnd.randrange(40))).encode() for _ in range(12)] + [b"", None]
    learn = [i % 3 != 0 for i in range(len(texts))]
    docs = pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.binary()), "learn": pa.array(learn)})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema) as out:
        out.write_table(docs)
    chunk = pa.table({"chunk": pa.array([0], pa.int32()), "blob": pa.array([sink.getvalue().to_pybytes()], pa.binary())})
    plain = Counter()
    for text, own in zip(texts, learn):
        coded = "".join(w + " " for w in plain_words((text or b"").decode())).encode() + b"\n"
        assert language_model.coded(text) == coded
        whole = language_model.START + coded
        for i in range(7, len(whole)):  # the nearest byte on top, the coded one lowest
            plain[int.from_bytes(whole[i - 7:i][::-1] + whole[i:i + 1])] += own
    got = {}
    for r in language_model.contents(chunk, language_model.SALTS).to_pylist():
        if not r["word"]:
            got |= zip(language_model.unsqueezed_rising(r["keys"]).tolist(), language_model.unsqueezed(r["counts"], np.int64).tolist())
    assert got == dict(plain)
    for keys in ([], [5], [3, 3, 9, 1, 3, 2**64 - 1]):
        names, at = language_model.ranked(np.array(keys, np.uint64))
        assert names.tolist() == sorted(set(keys)) and names[at].tolist() == keys


def test_toxicity_memory_of_a_run():
    """Windows are built of four-byte numbers (37 bytes a place at most before, 19 now), and scoring holds a run of two megabytes."""
    texts = [("w" + str(i % 50) + " mm nn oo ") * 40 for i in range(2000)]
    tracemalloc.start()
    run = toxicity.Run([t.encode() for t in texts])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert run.words.dtype == np.int32 and (run.words[~run.mask] == len(run.own)).all()
    assert peak < 24 * run.words.size
    begin, start = np.cumsum(run.counts) - run.counts, toxicity.windows(run.counts)[1]
    for i in (0, 1, len(run.text) - 1):
        first = begin[run.text[i]] + start[i]
        assert run.words[i][run.mask[i]].tolist() == run.flat[first:first + run.mask[i].sum()].tolist()
    assert toxicity.RUN_BYTES <= 2_000_000


def test_without_toxic_with_text_anywhere(spark, docs, monkeypatch):
    """The text column in the middle, runs of a row or two, rows with equal ids; texts travel once."""
    monkeypatch.setattr(toxicity, "RUN_BYTES", 10)
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice(["bad", "ugly", "calm", "kind"][:2] if i % 2 else ["calm", "kind"]) for _ in range(30)).encode() for i in range(60)]
    net = toxicity.train(texts, np.arange(60) % 2)
    df = spark.createDataFrame([(i // 2, t.decode(), "x") for i, t in enumerate(texts)] + [(None, None, "y")], "doc_id long, text string, _scored string")
    bad = net([*texts, None]) >= 0.5
    got = toxicity.without_toxic(df, net)
    assert got.columns == df.columns and Counter(map(tuple, got.collect())) == Counter(
        tuple(r) for r, b in zip(df.collect(), bad) if not b)
    assert 0 < bad.sum() < 61 and toxicity.without_toxic(df, None).count() == 61


def test_packing_is_lossless_and_best_fit(spark, docs, empty):
    ranks = {bytes([i]): i for i in range(256)}
    packed = packing.pack(docs.dropDuplicates(["doc_id"]), ranks, length=64, run_tokens=5000)
    back = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").astype(np.uint8).tobytes().decode() for r in packing.unpacked(packed).collect()}
    assert back == {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in packed.collect():
        at = np.frombuffer(r["position_ids"], "<u2")
        assert len(at) == 64 and r["cu_seqlens"][0] == 0 and all(at[i] == 0 for i in r["cu_seqlens"][:-1])
    assert packing.pack(empty, ranks).isEmpty()
    rng = np.random.default_rng(7)
    lengths = rng.integers(1, 65, 300)
    free, want = [], []
    for i in np.argsort(-lengths, kind="stable"):
        fits = [(room, row) for row, room in enumerate(free) if room >= lengths[i]]
        if fits:
            least = min(room for room, _ in fits)
            row = next(row for room, row in fits if room == least)
        else:
            row = len(free)
            free.append(64)
        free[row] -= lengths[i]
    assert len(packing.best_fit(lengths, 64)) == len(free)
    assert sorted(i for r in packing.best_fit(lengths, 64) for i in r) == list(range(300))


@pytest.mark.parametrize("range_chars", [1 << 20, 400])
def test_fingerprints_against_neighbours(spark, docs, empty, range_chars):
    got = rows(fingerprint.compare_next(docs, range_chars))
    table = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (-r[0], r[1]))
    want = []
    for k, (i, t) in enumerate(table):
        other = table[(k + 1) % len(table)][1]
        half = len(t) // 2
        want.append((i, len(t), hashlib.sha256((t[:len(t) - half] + other[:half]).encode()).hexdigest(), fingerprint.fingerprint(t)))
    assert sorted((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"]) for r in got) == sorted(want)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert fingerprint.compare_next(empty).isEmpty()
    assert fingerprint.fingerprint(None) == fingerprint.fingerprint("")


def test_fingerprints_locate_edits():
    text = "\n".join(f"paragraph {i} with a few words of its own {i * i}" for i in range(30))
    changed = text.replace("paragraph 17", "paragraph 99")
    a, b = fingerprint.fingerprint(text), fingerprint.fingerprint(changed)
    assert a != b and fingerprint.edits(a, b) == [(0, 17)] and fingerprint.edits(a, a) == []
    assert 0.9 < fingerprint.likeness(a, b) < 1 and fingerprint.likeness(a, a) == 1


def test_edits_align_equal_branches():
    sections = [[f"section {i} paragraph {j} of {i * j} words" for j in range(6)] for i in range(5)]
    def printed(parts):
        return fingerprint.fingerprint("\n\n".join("\n".join(p) for p in parts) + "\n\n")
    whole = printed(sections)
    more = [list(p) for p in sections]
    more[1].insert(2, "a paragraph put in")
    assert fingerprint.edits(whole, printed(more)) == [(1, 2)] and fingerprint.edits(printed(more), whole) == []
    more.insert(3, ["a section", "put in"])
    assert fingerprint.edits(whole, printed(more)) == [(1, 2), (3, 0), (3, 1), (3, 2)]
    less = [more[0], *more[2:]]
    assert fingerprint.edits(printed(more), printed(less)) == [] and len(fingerprint.edits(printed(less), printed(more))) == 8
    _, inner = fingerprint.tree("one\n\ntwo\nthree")
    assert [len(p) for _, p in inner] == [2, 2] and len({d for d, _ in inner}) == 2


def test_likeness_columns_against_piece_counts(spark, docs, monkeypatch):
    def like(x, y):
        p, q = fingerprint.pieces(fingerprint.fingerprint(x)), fingerprint.pieces(fingerprint.fingerprint(y))
        return 1.0 if x == y else sum((Counter(p) & Counter(q)).values()) / max(len(p), len(q), 1)
    table = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (-r[0], r[1]))
    want = []
    for k, (i, t) in enumerate(table):
        other, half = table[(k + 1) % len(table)][1], len(t) // 2
        want.append((i, len(t), like(t, t[:len(t) - half] + other[:half]), like(t, other)))
    for most in (3, 20_000):  # few ranges allowed, then as many as the size asks for
        monkeypatch.setattr(fingerprint, "RANGES", most)
        monkeypatch.setattr(fingerprint, "TASK_CHARS", 500)
        got = sorted((r["doc_id"], r["n_chars"], r["near_edited"], r["near_next"]) for r in rows(fingerprint.compare_next(docs, 400)))
        assert all(g[:2] == w[:2] and abs(g[2] - w[2]) + abs(g[3] - w[3]) < 1e-12 for g, w in zip(got, sorted(want), strict=True))


def test_fingerprints_of_long_unrelated_texts_are_unlike():
    rnd = random.Random(8)
    a, b = (fingerprint.fingerprint(" ".join(f"{rnd.getrandbits(40):x}" for _ in range(100_000))) for _ in range(2))
    assert len(fingerprint.pieces(a)) > 15_000 and fingerprint.likeness(a, b) < 1e-3


def test_very_long_runs_are_coded_losslessly():
    encoder = packing.Encoder(packing.read_ranks())
    encoder("")
    for text in (" " * 2_000_000, "\n" * 2_000_000 + "end", "a" + " \n\t" * 400_000 + " b", "x" * 300_000, "word " * 1000, " " * 120_000):
        assert encoder.model.decode([int(i) for i in encoder(text)[:-1]]) == text and encoder(text)[-1] == encoder.end
    plain = "two  blanks \n\n and  more   "
    assert encoder(plain)[:-1].tolist() == encoder.model.encode_ordinary(plain)


def test_mixed_texts_with_clashing_names(spark, docs):
    names = ("size", "passes", "runs", "taken", "target", "shard")
    clashing = docs.withColumns({c: F.lit(f"own {c}") for c in names})
    got = mixing.mixed_texts(clashing)
    assert got.columns == clashing.columns and {tuple(r) for r in got.select(*names).collect()} == {tuple(f"own {c}" for c in names)}
    assert sorted(rows(got.drop(*names)), key=str) == sorted(rows(mixing.mixed_texts(docs)), key=str)
