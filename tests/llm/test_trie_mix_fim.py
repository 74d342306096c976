"""Operators 11 to 13 against brute force: odd rows, ties, empty tables, long texts and conversations, clashing names."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import fill_middle, list_ranking, mixing, prefix_trie
from tessera.llm.counting import n_words

TURNS = "conv_id long, turn long, role string, text string, node string, place string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def trie_by_hand(rows, shared):
    convs = collections.defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    tie = lambda t: (*t[:3], t[3][:64], hashlib.md5(f"{len(t[2])}:{t[2]}{t[3]}".encode()).hexdigest())
    convs = {c: [t[2:] for t in sorted(ts, key=tie)] for c, ts in convs.items()}
    if shared:
        h = {c: zlib.crc32(str(c).encode()) % 4 for c in convs}
        base = {c: c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20)) for c in convs}
        convs = {c: convs.get(base[c], [])[: h[c]] + ts[h[c] :] for c, ts in convs.items()}
    nodes = collections.defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            nodes[tuple(ts[:d])].append(c)
    kids = collections.Counter(n[:-1] for n in nodes if n)
    leaves, saved = collections.Counter(), collections.Counter()
    for n, cs in nodes.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += n not in kids
            saved[n[:d]] += (len(cs) - 1) * len(WORD.findall(n[-1][1])) if n else 0
    ends = lambda n: ",".join(map(str, sorted(c for c in nodes[n] if len(convs[c]) == len(n))))
    return sorted((min(cs), len(n), min(nodes[n[:-1]]) if n else None, len(cs), kids[n], leaves[n], saved[n], hashlib.sha256(ends(n).encode()).hexdigest()) for n, cs in nodes.items())


def trie_rows(r, n):
    texts = ["", None, "a b", "c\td  e", "x" * 70 + "1", "x" * 70 + "2", "ü"]
    rows = []
    for c in [*range(-25, n), None]:
        start = r.random() < 0.5
        for t in range(r.choice([0, 1, 2, 3, 7]) if c is not None else 4):
            text = "same" if start and t < 3 else r.choice(texts)
            rows.append((c, r.choice([t, t, t, 0, None]), r.choice(["user", "user", None]), text, "n", "p"))
    return rows


@pytest.mark.parametrize("shared", [False, True])
def test_trie(spark, monkeypatch, shared):
    monkeypatch.setattr(prefix_trie, "BLOCK", 4)
    r = random.Random(5)
    rows = trie_rows(r, 90)
    rows += [(200, t, "user", f"long {t % 5}", "", "") for t in range(900)] + [(220, t, "user", f"long {t % 5}", "", "") for t in range(899)] + rows[:3]
    df = spark.createDataFrame(rows, TURNS)
    turns = prefix_trie.numbered_turns(df)
    out = prefix_trie.measured_trie(*prefix_trie.shared_heads(turns)) if shared else prefix_trie.prefix_trie(df)
    assert sorted(tuple(x) for x in out.collect()) == sorted(trie_by_hand(rows, shared), key=lambda x: tuple(v if v is not None else -99 for v in x))


def test_trie_of_nothing(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b", "", "")], TURNS)).count() == 0


def test_colliding_keys_are_drawn_anew(spark, monkeypatch):
    """The first keys put every prefix into one node; the check finds it."""
    real, seeds = prefix_trie.prefix_paths, []

    def poor(turns, seed):
        seeds.append(seed)
        return real(turns, seed) if len(seeds) > 1 else real(turns, seed).withColumn("node", F.lit(2).cast("long"))

    monkeypatch.setattr(prefix_trie, "prefix_paths", poor)
    rows = [(c, t, "user", f"{c % 3} {t}", "", "") for c in range(9) for t in range(3)]
    out = prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS))
    assert len(seeds) == 2 and sorted(map(tuple, out.collect()))[1:] == trie_by_hand(rows, False)[1:]


@pytest.mark.parametrize(("near", "broadcast"), [("order", 10**6), ("random", 10**6), ("random", 0)])
def test_list_positions(spark, monkeypatch, near, broadcast):
    """Several levels, by neighbourhood and by coin flips, with tasks that hold few items."""
    monkeypatch.setattr(list_ranking, "LAST", 200)
    monkeypatch.setattr(list_ranking, "A_TASK", 300)
    monkeypatch.setattr(list_ranking, "BROADCAST_ROWS", broadcast)
    r = random.Random(2)
    ids = r.sample(range(-(10**15), 10**15), 4000)
    rows = [(a, b, i if near == "order" else r.randrange(10**9), 0) for i, (a, b) in enumerate(zip(ids, [*ids[1:], None], strict=True))]
    r.shuffle(rows)
    out = list_ranking.list_positions(spark.createDataFrame(rows, "id long, next long, near long, depth long"))
    assert {x["id"]: x["pos"] for x in out.collect()} == {a: i for i, a in enumerate(ids)}


def test_running_sums(spark):
    rows = [(3 * i, i % 7) for i in range(500)]
    out = list_ranking.running_sums(spark.createDataFrame(rows, "at long, v long"), "at", ["v"], width=5)
    assert {x["at"]: x["v"] for x in out.collect()} == {a: sum(v for b, v in rows if b <= a) for a, _ in rows}


def mix_by_hand(rows, weights=(3, 1, 2), share=1.5, limit=2):
    """Targets in exact numbers, then documents by hash, word by word."""
    from fractions import Fraction

    size = [len(WORD.findall(text or "")) for _, _, text, *_ in rows]
    total = collections.Counter()
    for (_, source, *_), n in zip(rows, size, strict=True):
        total[source] += n
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, budget, left = {}, Fraction(share) * sum(size), set(order)
    while True:
        level = Fraction(budget, sum(weight[s] for s in left)) if left else 0
        full = {s for s in left if level * weight[s] > limit * total[s]}
        if not full:
            break
        for s in full:
            target[s] = limit * total[s]
            budget -= target[s]
        left -= full
    target |= {s: level * weight[s] for s in left}
    return size, total, target


DOCS = "doc_id long, source string, text string, size string, h string"


@pytest.mark.parametrize("broadcast", [10**6, 0])
def test_mixing(spark, monkeypatch, broadcast):
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", broadcast)
    r = random.Random(1)
    sources = ["b", None, "", "é", "z", "\U0001f600", "a"]
    rows = [(r.choice([i, i, None]), "hot" if r.random() < 0.4 else r.choice(sources), r.choice([None, "", " \n", "w", *["w " * r.randrange(1, 60)] * 4]), "s", "h") for i in range(900)]
    rows += [(5, "one", "a b c", "", "")] + [(7, "twins", "x y z", "", "")] * 40 + [(9, "none", " ", "", "")]
    out = mixing.mix_sources(spark.createDataFrame(rows, DOCS))
    assert out.columns == ["doc_id", "size", "source_size", "target", "taken"]
    got = collections.Counter(tuple(x) for x in out.collect())
    size, total, target = mix_by_hand(rows)
    hashed = [int(hashlib.md5(f"{'' if d is None else d}|{t or ''}".encode()).hexdigest()[:15], 16) for d, _, t, *_ in rows]
    want = collections.Counter()
    for s in total:
        budget = int(target[s] + 0.5)
        times, rest = divmod(budget, total[s]) if total[s] else (0, 0)
        mine = collections.defaultdict(list)
        for (d, source, *_), n, h in zip(rows, size, hashed, strict=True):
            if source == s:
                mine[h].append((d, n))
        upto = taken = 0
        for h in sorted(mine):
            tied = sum(n for _, n in mine[h])
            for d, n in mine[h]:
                got_here = times * n + (n * max(0, min(tied, rest - upto)) // tied if tied else 0)
                want[(d, n, total[s], round(float(target[s]), 6), got_here)] += 1
                taken += got_here
                assert got_here <= 2 * n
            upto += tied
        assert abs(taken - target[s]) <= 1 + (40 if s == "twins" else 0)
    assert collections.Counter({(*k[:3], round(k[3], 6), k[4]): n for k, n in got.items()}) == want


def test_mixing_of_nothing(spark):
    assert mixing.mix_sources(spark.createDataFrame([], DOCS)).count() == 0
    out = mixing.mix_sources(spark.createDataFrame([(1, "a", None, "", ""), (2, None, " ", "", "")], DOCS)).collect()
    assert sorted((x["doc_id"], x["size"], x["target"], x["taken"]) for x in out) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    one = mixing.mix_sources(spark.createDataFrame([(1, "a", "x " * 10, "", "")], DOCS)).first()
    assert (one["target"], one["taken"]) == (15.0, 15)


def test_words_between_blanks(spark):
    r = random.Random(4)
    texts = ["", " ", "a", " a", "a ", *("".join(r.choice("ab \t\n\x0b\x0c\r\x1c\x85 ü") for _ in range(r.randrange(30))) for _ in range(300))]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", n_words(F.col("t")).alias("n")).collect()
    assert all(x["n"] == len(WORD.findall(x["t"])) for x in rows)


def fim_by_hand(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n, digest = len(units), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", text, None, None
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form = "spm" if h[3] % 100 < 20 else "psm"
    return doc_id, n, form, f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def test_fill_in_middle(spark):
    r = random.Random(3)
    parts = ["a", "Bc", "<", ">", "P", "<P", "S>", "$1", "\\", "\n", " ", "é", "\U0001f600", " ", "1", "<M>"]
    texts = [None, "", *("".join(r.choice(parts[:-1] if r.random() < 0.9 else parts) for _ in range(r.randrange(1, 40))) for _ in range(600))]
    texts += ["x" * 2_000_000, "ab " * 400_000, " " * 300_000, "y" * 1024, "z " * 512, "z " * 1024 + "z"]
    rows = [(r.choice([i, i, i, 3, None]), t, "n", "f", "o") for i, t in enumerate(texts)] * 2
    out = fill_middle.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string, n string, form string, output string"))
    got = out.withColumn("again", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    assert collections.Counter(tuple(x)[:6] for x in got) == collections.Counter(fim_by_hand(d, t) for d, t, *_ in rows)
    assert collections.Counter((x["doc_id"], x["again"]) for x in got) == collections.Counter((d, t or "") for d, t, *_ in rows)
    assert {x["form"] for x in got} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).count() == 0
