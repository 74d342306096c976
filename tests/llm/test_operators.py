"""Each operator against brute force on a small table with nulls, empty and long texts, ties, repeats and clashing columns."""

import collections
import hashlib
import itertools
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import chat, decontaminate, fuzzy_lines, neardup, neighbours, order_minhash, packing, repeats, secrets, toxicity, wavelet
from tessera.llm.components import components
from tessera.llm.encoding import PieceEncoder

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
rng = random.Random(4)
VOCAB = ["".join(rng.choice("abcdeéü") for _ in range(rng.randint(2, 7))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCAB) + r.choice(["", "", ",", ".\n"]) for _ in range(n))


BASE = [prose(120, k) for k in range(12)]
TEXTS = [*BASE, None, "", " ", "A", "one two", BASE[0], BASE[0], BASE[1].replace(VOCAB[3], "other", 1), BASE[2] + " tail", prose(4000, 99), BASE[3][:400] + prose(60, 50), "x\n" * 5, "É, À.", BASE[4].upper()]
ROWS = [(i, t, "e", f"s{i}", 0) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "e", "again", 0), (None, BASE[5], "e", None, 0)]


@pytest.fixture(scope="module")
def docs(spark):
    # extra columns with names that the operators use inside
    return spark.createDataFrame(ROWS, "doc_id long, text string, row string, id string, n int")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def lower(t):
    return "".join(c.lower() if c.isascii() else c for c in t)


def test_secrets(docs, empty):
    key = "token = 'aZ3kQ9xT7LmP2vWc8RbY'"
    df = docs.unionByName(docs.sparkSession.createDataFrame([(90, f"{BASE[0]} PASSWORD: abcdef123456789 AKIA{'B' * 16} {'0f' * 10} {key}", "", "", 0)], docs.schema))
    rows = secrets.scan_secrets(df).collect()
    assert len(rows) == len(ROWS) + 1 and secrets.scan_secrets(empty).count() == 0
    got = next(r for r in rows if r["doc_id"] == 90)
    assert (got["n_assign"], got["n_access"], got["n_hex"]) == (2, 1, 1) and got["n_novel"] >= 1
    text = df.where("doc_id = 90").first()["text"]
    kinds = [s.split(":") for s in got["spans"].split(",")]
    assert [k for k, *_ in kinds if k != "novel"] == ["assign", "access", "hex", "assign"] and [int(a) for _, a, _ in kinds] == sorted(int(a) for _, a, _ in kinds)
    assert any("aZ3kQ9xT7LmP2vWc8RbY" in text[int(a) : int(b)] for k, a, b in kinds if k == "novel")
    scanner = secrets.Scanner()
    assert scanner.marginal_bytes("", "passwordpasswordpassword", "") < scanner.marginal_bytes("", "kX93jQmZ0aLw81VbTrY4pNce", "")
    assert all(r["spans"] == "" for r in rows if r["doc_id"] in (12, 13, 14))


def brute_hits(texts, items, size=10):
    windows = collections.defaultdict(set)
    for name, t in items:
        w = WORD.findall(lower(t or ""))
        m = min(size, len(w))
        for s in range(len(w) - m + 1 if m else 0):
            windows[tuple(w[s : s + m])].add(name)
    for t in texts:
        w = WORD.findall(lower(t or ""))
        hit, found = set(), set()
        for m in {len(k) for k in windows}:
            for p in range(len(w) - m + 1):
                if names := windows.get(tuple(w[p : p + m])):
                    hit |= set(range(p, p + m))
                    found |= names
        yield len(w), len(hit), sorted(found)


@pytest.mark.parametrize("broadcast", [True, False])
def test_decontaminate(spark, docs, empty, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", -1)
    w = BASE[0].split()
    items = [(1, " ".join(w[10:25])), (2, "one two"), (3, "A"), (4, None), (5, ""), (6, " ".join(BASE[1].split()[:8])), (7, prose(30, 777)), (8, " ".join(w[3:12]) + " zzz"), (10, " ".join(w[10:25]))]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(1))
    rows = decontaminate.decontaminate(docs, bench).collect()
    want = collections.Counter((r[0], *(x if not isinstance(x, list) else tuple(x) for x in b)) for r, b in zip(ROWS, brute_hits([r[1] for r in ROWS], [(str(i), t) for i, t in items]), strict=True))
    assert collections.Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in rows) == want
    assert all(r["contaminated"] == (r["n_hit"] > 0) for r in rows)
    assert decontaminate.decontaminate(empty, bench).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.decontaminate(docs, bench.where("false")).collect())


def groups(pairs, ids):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_near_duplicates(docs, empty):
    got = order_minhash.near_duplicates(docs)
    rows = got.collect()
    assert len(rows) == len(ROWS) and order_minhash.near_duplicates(empty).count() == 0
    sets = {}
    for i, t in enumerate(TEXTS):
        w = WORD.findall(lower(t or ""))
        if w:
            sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    pairs = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    want = groups(pairs, range(len(TEXTS)))
    assert {r["doc_id"]: r["class_id"] for r in rows if r["doc_id"] is not None} == want
    assert all(r["keep"] == (r["class_id"] in (r["doc_id"], None)) for r in rows)
    assert [(r["class_id"], r["keep"]) for r in rows if r["doc_id"] is None] == [(None, True)]


def test_large_group_of_near_copies(spark):
    words = prose(200, 5).split()
    rows = []
    for i in range(400):
        w = list(words)
        w[i % 200] = f"w{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, prose(200, 2000 + i)) for i in range(50)]
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[i] for i in range(400)} == {0} and all(got[1000 + i] == 1000 + i for i in range(50))


def test_alignment_keeps_order():
    x = np.arange(100, dtype=np.uint64)
    assert order_minhash.aligned_similarity(x, x) == 1.0
    assert order_minhash.aligned_similarity(x, np.delete(x, 5)) == 99 / 100
    assert order_minhash.aligned_similarity(x, np.concatenate((x[50:], x[:50]))) == 0.0
    assert order_minhash.aligned_similarity(x, x[:40]) == 0.0


@pytest.mark.parametrize("task_links", [1 << 18, 2])
def test_components(spark, monkeypatch, task_links):
    """One task's worth of links, and star rounds over several; forests are cut at the bound, too."""
    monkeypatch.setattr("tessera.llm.components.TASK_LINKS", task_links)
    links = [(i, i + 1) for i in range(40)] + [(100, 102), (101, 102), (7, 7), (0, 40)]
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_packing(docs, empty):
    path = P.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = packing.pack_documents(docs, path, capacity=256, with_ids=True).collect()
    bins, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append(r)
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    for i, t in enumerate(TEXTS):
        if i == 3:
            continue  # stands twice
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        parts = sorted(by_doc[i], key=lambda r: r["start"])
        assert np.frombuffer(b"".join(r["ids"] for r in parts), "<u4").tolist() == ids and all(r["doc_tokens"] == len(ids) for r in parts)
    assert packing.pack_documents(empty, path).count() == 0


def test_first_fit_decreasing():
    lengths = [random.Random(1).randint(1, 100) for _ in range(300)]
    places = packing.first_fit_decreasing(lengths, 100)
    free, want = [], {}
    for i in sorted(range(300), key=lambda i: -lengths[i]):
        b = next((k for k, f in enumerate(free) if f >= lengths[i]), None)
        if b is None:
            b = len(free)
            free.append(100)
        want[i] = (b, 100 - free[b])
        free[b] -= lengths[i]
    assert places == [want[i] for i in range(300)]


@pytest.mark.parametrize(("name", "spaced"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_piece_encoder(name, spaced):
    tokenizer, encoder = Tokenizer.from_file(P.path(name)), PieceEncoder(P.path(name), spaced, max_kept=300)
    odd = ["a  b", " a", "a ", "a \n b", "a\n\n\nb", "it's x 's", "f<|endoftext|>b <|ENDOFTEXT|> c", "ΑΣ Σ.", "é", " x y", "a\x1cb c", "ß ẞ ǅ İ", "12 3,4 !!."]
    for t in [*filter(None, TEXTS), *odd]:
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_neighbours(spark):
    g = np.random.default_rng(2)
    x = g.normal(size=(600, 8)).round(2)
    x[300:420] = x[7]  # many copies of one vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(700, None), (800, [0.0] * 8), (900, [float("nan")] * 8), (1000, [None] + [1.0] * 7), (1100, [1.0, 2.0]), (None, [1.0] * 8), (5, x[5].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in neighbours.nearest(df, sample_rows=200, leaf_rows=32, block_rows=20, query_block=2).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert sorted(got) == [0, 100, 200, 300, 400, 500] and all(len(v) == 10 for v in got.values())
    found = 0
    for q, near in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        order = [i for i in np.lexsort((np.arange(600), d)) if i != q][:10]
        found += len({v for v, _ in near} & set(order))
        assert all(abs(s - d[v]) < 1e-12 for v, s in near) and near == sorted(near, key=lambda p: (p[1], p[0]))
    assert found >= 54
    assert [v for v, _ in got[400]] == [7, *range(300, 309)]
    assert neighbours.nearest(df.where("false")).count() == 0


def test_wavelet(docs, empty):
    path = P.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    shards = wavelet.write_shards(docs.where("doc_id is not null"), path, shard_tokens=500)
    assert shards.count() > 3 and wavelet.read_shards(wavelet.write_shards(empty, path)).count() == 0
    unnamed = wavelet.read_shards(wavelet.write_shards(docs, path, shard_tokens=500)).orderBy("start").first()
    assert (unnamed["doc_id"], unnamed["start"]) == (None, 0)
    rows = sorted(wavelet.read_shards(shards).collect(), key=lambda r: r["start"])
    at = 0
    for (i, t, *_), r in zip(sorted((r for r in ROWS if r[0] is not None), key=lambda r: (r[0], r[1] or "")), rows, strict=True):
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert wavelet.read_shards(wavelet.write_shards(empty, path)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 512, 3000, 1_100_000])
def test_wavelet_access_count_locate(n):
    ids = np.random.default_rng(3).integers(0, 50, n).astype(np.uint32)
    m, docs, lengths = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(ids).to_bytes([1], [n]))
    assert docs == [1] and lengths == [n] and not m._open
    if n > 1_000_000:  # one access opens one frame a plane
        assert m.access(5) == ids[5] and len(m._open) == 6 < sum(map(len, m.frames))
    assert (m.whole() == ids).all() and (m.extract(0, n) == ids).all() and (m.extract(n // 3, n // 2) == ids[n // 3 : n // 2]).all()
    for i in {0, 1, 7, 8, 63, 64, 511, 512, 2999, 524_287, 524_288, n - 1}:
        assert not 0 <= i < n or m.access(i) == ids[i]
    for token in (0, 17, 49, 50, 1000):
        assert m.count(token) == (ids == token).sum() and m.count(token, n // 30, n // 4) == (ids[n // 30 : n // 4] == token).sum()
        places = np.flatnonzero(ids == token)
        for k in {0, 1, len(places) // 2, len(places) - 1, len(places)} - {-1}:
            assert m.locate(token, k) == (places[k] if k < len(places) else -1)


def brute_repeats(texts, length=200):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[p : p + length] for b in data for p in range(len(b) - length + 1))
    for b in data:
        covered = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                covered[p : p + length] = True
        spans = int((covered[:-1] & ~np.concatenate(([False], covered[:-2]))).sum()) if len(b) else 0
        yield len(b), int(covered.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~covered[:-1]])).hexdigest()


@pytest.mark.parametrize("small", [False, True])
def test_repeats(spark, empty, monkeypatch, small):
    if small:  # many shards, split grams and joins without broadcast
        monkeypatch.setattr(repeats, "SHARD_BYTES", 2000)
        monkeypatch.setattr(repeats, "SHARD_RUNS", 2)
        monkeypatch.setattr(repeats, "RANGE_WINDOWS", 300)
        monkeypatch.setattr(repeats, "BROADCAST_ROWS", -1)
    passage = prose(60, 31)
    texts = [r[1] for r in ROWS] + ["ab" * 300, "z" * 199, "z" * 200, "q" * 201, "\x00" * 450] + [prose(20, 500 + k) + passage + prose(20 + k, 600 + k) for k in range(12)]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = {r["doc_id"]: tuple(r)[1:] for r in repeats.remove_repeats(df).collect()}
    assert [got[i] for i in range(len(texts))] == [*brute_repeats(texts)]
    assert repeats.remove_repeats(empty).count() == 0


def test_repeats_are_dealt_by_row_at_every_size(spark):
    texts = [prose(60, 31) + prose(20, k) for k in range(4)]
    out = repeats.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert all(r["n_removed"] >= 200 for r in out.collect())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_suffix_order():
    text = np.frombuffer((b"banana" * 40 + b"band" * 9)[:270], np.uint8)
    order, levels = repeats.refine(text, 512)
    raw = text.tobytes()
    assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    common = repeats.neighbour_prefixes(order, levels, text, 200)

    def prefix(a, b):
        n = 0
        while max(a, b) + n < len(raw) and raw[a + n] == raw[b + n]:
            n += 1
        return min(n, 200)

    assert common[1:].tolist() == [prefix(a, b) for a, b in zip(order[1:], order[:-1], strict=True)]


def test_toxicity(spark, empty):
    abuse = ["grumbold", "sploteface"]
    rows, labels = [], []
    for i in range(400):
        bad = i % 5 == 0
        text = prose(40, 3000 + i)
        rows.append((i, text + (f" you {abuse[i % 2]} go" if bad else ""), "x"))
        labels.append((i, int(bad)))
    rows += [(900, None, ""), (901, "", ""), (902, prose(40, 1) + " you grumbol go", ""), (903, prose(9000, 2), ""), (904, prose(40, 3), "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    model = toxicity.trained(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, model).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all((got[i] >= 0.3) == (i % 5 == 0) for i in held) and got[900] == got[901] == got[904] < 0.3 and got[903] < 0.3
    assert all(0 <= s <= 1 for s in got.values())
    assert toxicity.score_toxicity(empty, model).count() == 0
    assert toxicity.trained(docs, spark.createDataFrame([], "doc_id long, toxic int")).beta[-1] < 0


def test_lexicon():
    lexicon = toxicity.Lexicon([("=idiot", 2.0), ("=scum", 1.0), ("^lowei", 3.0)])
    assert lexicon.lookup("idiot") == (2.0, 0) and lexicon.lookup("loweischaft") == (3.0, 0)
    for near in ("idiott", "idot", "idxot", "xidiot"):
        assert lexicon.lookup(near) == (2.0, 1)
    assert lexicon.lookup("scumx") == (1.0, 1)
    for far in ("idoit", "scumxy", "ideots", "lowe"):
        assert lexicon.lookup(far)[0] == 0
    text = 'he said "you idiot" to them\nyou idiot'
    first, second = (m.start() for m in re.finditer("idiot", text))
    assert toxicity.quoted(text, first, first + 5) and not toxicity.quoted(text, second, second + 5)


def test_line_dedup(spark, empty):
    line = "The quick brown fox jumps over the lazy dog and runs into the deep green forest nearby."
    other = prose(40, 8).replace("\n", " ")
    rows = [(1, f"{line}\n{other}\nshort"), (2, f"  {line.upper()}  \nshort\nshort"), (3, line.replace("lazy dog", "lazy dig")), (4, None), (5, ""), (6, prose(50, 11).replace("\n", " ")), (7, f"{line}\n{line}"), (None, f"{other}\nx"), (1, f"{line}\n{other}\nshort")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, removed string")
    got = sorted((str(r["doc_id"]), r["n_lines"], tuple(r["removed"])) for r in fuzzy_lines.fuzzy_line_dedup(df).collect())
    # the null id stands first in the order of documents, so its line stays
    assert got == sorted([("1", 3, (1,)), ("1", 3, (1,)), ("2", 3, (0,)), ("3", 1, (0,)), ("4", 1, ()), ("5", 1, ()), ("6", 1, ()), ("7", 2, (0, 1)), ("None", 2, ())])
    left = fuzzy_lines.without_repeated_lines(df)
    assert left.columns == df.columns and left.where("doc_id in (2, 3, 7)").count() == 0
    assert {r["text"] for r in left.where("doc_id = 1").collect()} == {f"{line}\nshort"} and left.where("doc_id in (4, 5)").count() == 2
    assert fuzzy_lines.fuzzy_line_dedup(empty).count() == 0


def test_chat(spark):
    r = random.Random(5)
    odd = ["</s>", "[INST] x [/INST]", "\\", "\\l\\b\\\\", "", None, "<", "[", "a\nb", "é" * 50]
    rows = []
    for c in [*range(30), None]:
        n = 60 if c == 3 else r.randint(1, 9)
        for t in range(n):
            rows.append((c, t, r.choice(["user", "assistant", "assistant", None]) if t else r.choice(["system", "user"]), r.choice(odd) if r.random() < 0.4 else prose(r.randint(1, 200), r.random()), "x"))
    rows.append(rows[0])
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string")
    windows = chat.format_chat(df, budget=512, history=128)
    got = {x["conv_id"]: x for x in chat.read_chat(windows).collect()}
    want = collections.defaultdict(list)
    for c, t, role, text, _ in rows:
        want[c].append((t, role or "", text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        turns = [(role, text) for _, role, text in sorted(turns)]
        assert [(t["role"], t["text"]) for t in got[c]["turns"]] == turns
        assert got[c]["targets"] == [text for role, text in turns if role == "assistant"]
    shown = windows.where("conv_id = 3").orderBy("window_id").collect()
    assert len(shown) > 2 and all(len(w["loss"]) > 0 or "assistant" not in w["formatted"] or w["n_repeated"] for w in shown)
    for w in shown:
        assert sum(-(-len(p.split("[/INST]", 1)[1]) // 4) + 1 for p in w["formatted"].split("</s>") if p) <= 512 or w["formatted"].count("</s>") <= w["n_repeated"] + 1
    assert chat.read_chat(chat.format_chat(df.where("false"))).count() == 0


def windows_by_hand(turns, budget, history, block):
    """(first, last, repeated places, system turn repeated) of each window, turn by turn."""
    tokens = [-(-len(text) // 4) + 1 for _, text in turns]
    system = turns[0][0] == "system"
    spare = max(1, budget - (tokens[0] if system else 0) - history)
    starts, total = [], 0
    for i, n in enumerate(tokens):
        if i % block == 0 or total + n > spare:
            starts.append(i)
            total = 0
        total += n
    for first, after in zip(starts, [*starts[1:], len(turns)], strict=True):
        back = first
        while back > (1 if system else 0) and sum(tokens[back - 1 : first]) <= history:
            back -= 1
        yield first, after, [*([0] if system and first else []), *range(back, first)]


@pytest.mark.parametrize("block", [40, 4096])
def test_chat_windows(spark, monkeypatch, block):
    """Choice of windows, repeats, mask and offsets of every window; one conversation holds most rows."""
    monkeypatch.setattr(chat, "BLOCK", block)
    r = random.Random(9)
    rows = [(c, t, "system" if t == 0 and c % 2 else r.choice(["user", "assistant"]), "w" * r.choice([0, 3, 40, 90, 700])) for c in range(6) for t in range(400 if c == 1 else r.randint(1, 30))]
    budget, history = 120, 35
    got = {}
    for x in chat.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), budget, history).collect():
        got[x["conv_id"], x["window_id"]] = (x["formatted"], x["n_repeated"], [tuple(s) for s in x["loss"]])
    want = {}
    for c in range(6):
        turns = [(role, text) for k, _, role, text in rows if k == c]
        for first, after, repeated in windows_by_hand(turns, budget, history, block):
            formatted, loss = "", []
            for i in [*repeated, *range(first, after)]:
                role, text = turns[i]
                formatted += f"[INST]{role}[/INST]"
                if i >= first and role == "assistant":
                    loss.append((len(formatted), len(text)))
                formatted += f"{text}</s>"
            want[c, first] = (formatted, len(repeated), loss)
    assert got == want


def test_long_conversation(spark):
    """10,000 turns and as many rows without an id; seconds, as no step is quadratic in them."""
    began = time.time()
    df = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 4 < 2, "user").otherwise("assistant").alias("role"), F.repeat(F.lit("some words "), (F.col("id") % 60).cast("int")).alias("text"))
    windows = chat.format_chat(df)
    read = {x["conv_id"]: x for x in chat.read_chat(windows).select("conv_id", F.size("turns").alias("n"), F.size("targets").alias("t")).collect()}
    assert {k: (v["n"], v["t"]) for k, v in read.items()} == {7: (10_000, 5_000), None: (10_000, 5_000)}
    assert time.time() - began < 100


def test_inner_member_of_a_large_component(spark, monkeypatch):
    # 60 sets in a chain, each similar to its neighbours only, and strays that are similar to one inner member each; all share one bucket
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 8)

    def near(x, y):
        return len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y])

    sets = {k: set(range(10 * k, 10 * k + 100)) for k in range(60)}
    for k in range(60, 70):
        sets[k] = (sets[5 * (k - 60) + 3] - {50 * (k - 60) + 80}) | {10_000 + k}
    texts = spark.createDataFrame([(k, " ".join(map(str, sorted(s)))) for k, s in sets.items()], "id long, text string")
    entries = spark.createDataFrame([(k, [8]) for k in sets], "id long, entries array<long>")
    live = spark.createDataFrame([(8, k, 100) for k in sets], "bucket long, id long, n long")

    def verify(pairs):
        return spark.createDataFrame([(r["ra"], r["rb"]) for r in pairs.collect() if near(r["a"], r["b"])], "ra long, rb long")

    content = neardup.Content(texts, lambda ts: [np.array(t.split(), dtype=np.uint64) for t in ts], None, verify, True)
    got = {r["id"]: r["root"] for r in neardup.near_links(live, entries, 0.8, content, 1).collect()}
    assert got == groups([(x, y) for x, y in itertools.combinations(sets, 2) if near(x, y)], sets)


def test_text_of_many_cells_is_joined_once(spark, monkeypatch):
    # 30 sets in three buckets, none similar: blocks of 4 give each many cells, but a task reads its text and entries once
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 4)
    made, materialize = {}, neardup.materialize

    def counted(df, name):
        made[name] = materialize(df, name)
        return made[name]

    monkeypatch.setattr(neardup, "materialize", counted)
    ids = range(30)
    texts = spark.createDataFrame([(k, " ".join(str(1000 * k + i) for i in range(20))) for k in ids], "id long, text string")
    entries = spark.createDataFrame([(k, [8, 9, 10]) for k in ids], "id long, entries array<long>")
    open_ = spark.createDataFrame([(b, k, 20, k) for b in (8, 9, 10) for k in ids], "bucket long, id long, n long, root long")
    content = neardup.Content(texts, lambda ts: [np.array(t.split(), dtype=np.uint64) for t in ts], None, None, True)
    assert neardup.block_links(open_, entries, 0.8, content).count() == 0
    assert made["cells"].count() > 3 * 5 * len(ids) and made["places"].count() == len(ids)


def test_equal_lines_go_to_buckets_once(spark, monkeypatch):
    given, shared = [], fuzzy_lines.shared_buckets

    def counted(rows, *args, **kw):
        given.append(rows)
        return shared(rows, *args, **kw)

    monkeypatch.setattr(fuzzy_lines, "shared_buckets", counted)
    line = "a line that stands in every one of the documents"
    docs = spark.createDataFrame([(k, f"{line}\nshort\n{prose(12, 700 + k)}") for k in range(20)], "doc_id long, text string")
    got = {r["doc_id"]: r["removed"] for r in fuzzy_lines.fuzzy_line_dedup(docs, least=1).collect()}
    assert got == {0: [], **{k: [0, 1] for k in range(1, 20)}}
    lines = fuzzy_lines.line_bands(fuzzy_lines.with_row(docs, "doc_id", "text"), 1).where("size(bands) > 0")
    want = {r["id"]: [(key << 4) | band for band, key in enumerate(r["bands"])] for r in lines.collect()}
    assert given[0].count() == len(want) * fuzzy_lines.BANDS < lines.count() * fuzzy_lines.BANDS
    assert {r["id"]: r["entries"] for r in fuzzy_lines.different_lines(lines).collect()} == want


def test_only_lines_in_question_are_dealt(spark, monkeypatch):
    passed, among = [], fuzzy_lines.among

    def kept(rows, wanted, *key):
        passed.append((rows, wanted, among(rows, wanted, *key)))
        return passed[-1][-1]

    monkeypatch.setattr(fuzzy_lines, "among", kept)
    own = [prose(300, 800 + k).replace("\n", f" {k}\n") for k in range(30)]
    line = "this line stands in two of the documents, in one of them with another end"
    docs = spark.createDataFrame([(k, f"{line}{'.' * (k == 7)}\n{x}" if k in (3, 7) else x) for k, x in enumerate(own)], "doc_id long, text string")
    got = {r["doc_id"]: r["removed"] for r in fuzzy_lines.fuzzy_line_dedup(docs).collect()}
    assert got == {k: [0] if k == 7 else [] for k in range(30)}
    [(rows, wanted, some)] = passed
    held = {(r["row"], r["line_no"]) for r in wanted.collect()}
    assert held <= {(r["row"], r["line_no"]) for r in some.collect()} and some.count() <= len(held) + rows.count() // 10


def test_filter_of_places_loses_none(spark, monkeypatch):
    rows = spark.range(60000).select(F.col("id").alias("row"), (F.col("id") % 7).cast("int").alias("line_no"))
    wanted = rows.where("row % 20 = 0")
    for most, share in ((1 << 28, 0.08), (1 << 15, 0.2), (1 << 10, 1)):  # a full filter lets more pass
        monkeypatch.setattr(fuzzy_lines, "MOST_BITS", most)
        some = fuzzy_lines.among(rows, wanted, "row", "line_no")
        assert some.intersect(wanted).count() == 3000 and some.columns == rows.columns and some.count() <= 3000 + 57000 * share


def test_similar_lines_against_sets():
    r = random.Random(6)
    lines = ["abcdefghijkl", "abcdefghijk", "ABCDEFGHIJKL ", "a" * 40, "a" * 9, "abcdefgh", "abcdefgx", "x" * 200000 + "yz", "x" * 150000 + "yz"]
    for k in range(40):
        line = prose(r.choice([2, 5, 30, 200]), 900 + k).replace("\n", " ") + " and so on"
        lines += [line, line[: int(len(line) * r.uniform(0.7, 1))], line.replace("a", "o", r.randint(1, 3)), line.upper()]
    pairs = [*itertools.combinations(lines, 2)]
    sets = {x: fuzzy_lines.shingle_set(fuzzy_lines.lower_ascii(x).strip(fuzzy_lines.EDGE)) for x in lines}
    want = [len(sets[x] & sets[y]) / len(sets[x] | sets[y]) >= 0.8 for x, y in pairs]
    assert [*fuzzy_lines.similar_pairs(*map(list, zip(*pairs, strict=True)))] == want and want[0] and 40 < sum(want) < len(want) // 2


def test_entries_of_lines_keep_their_band(spark):
    live = spark.createDataFrame([(5 << 4, 1), (-9 << 4 | 7, 1), (5 << 4, 2), (6 << 4 | 3, 2)], "bucket long, id long")
    got = {r["id"]: r["entries"] for r in fuzzy_lines.shared_entries(live).collect()}
    assert got == {1: [80, 1, 1, 1, 1, 1, 1, -137], 2: [80, 2, 2, 99, 2, 2, 2, 2]}


def test_short_lines(spark):
    rows = [(1, "Home | About | Contact us\n\nown\n}"), (2, "home | about | contact us \n\n}\n目次"), (3, "Home | About | Contact us.\nelse\n目次")]
    got = fuzzy_lines.fuzzy_line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), least=1).collect()
    assert {r["doc_id"]: r["removed"] for r in got} == {1: [], 2: [0, 2], 3: [0, 2]}


def test_own_short_text_under_a_shared_header_stays(spark):
    header = "Licensed under the terms of the example licence, version two, without any warranty."
    rows = [(1, f"{header}\nint a;"), (2, f"{header}\nint b;"), (3, f"{header}\n \t"), (4, f"{header}\nint a;")]
    left = fuzzy_lines.without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["text"] for r in left.collect()} == {1: f"{header}\nint a;", 2: "int b;"}


def test_secret_of_letters_and_secret_before_its_word():
    value = "kXvQjmZqaLwpVbTrYzNceHgF"
    for text in (f"the password is {value} here", f"{value} is the token", f"{'a ' * 20}x{value} {'b ' * 20} password"):
        [(start, _, end)] = secrets.Scanner().novel(text)
        assert value in text[start:end] and end - start <= len(value) + 1
    assert secrets.Scanner().novel(f"{value} {'b ' * 40} password") == []
