"""Similar texts in families that share most of what the sketches see, against brute force over all pairs."""

import random

import numpy as np
import pytest

from tessera.llm import fuzzy_lines, neardup, order_minhash


def groups(ids, pairs):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


def jaccard_pairs(sets, floor=0.8):
    ids = sorted(sets)
    names = {t: k for k, t in enumerate(sorted(set().union(*sets.values())))}
    m = np.zeros((len(ids), len(names)), dtype=np.float32)
    for i, x in enumerate(ids):
        m[i, [names[t] for t in sets[x]]] = 1
    both, size = m @ m.T, m.sum(1)
    near = np.triu(both >= floor * (size[:, None] + size[None] - both) - 1e-4, 1)
    return [(ids[i], ids[j]) for i, j in zip(*np.nonzero(near), strict=True)]


def template_family(n_pairs, words=200, own=13, pair_own=0, seed=0):
    """Texts of one template; two each share ``pair_own`` more words in place of the template's, so only they are similar enough."""
    r = random.Random(seed)
    template = [f"t{seed}x{k}" for k in range(words)]
    out = []
    for p in range(n_pairs):
        places = r.sample(range(0, words, 5), own + pair_own)
        for side in range(2):
            w = list(template)
            for k in places[:pair_own]:
                w[k] = f"p{seed}x{p}x{k}"
            for k in r.sample(range(2, words, 5), own - pair_own) if side else places[pair_own:own]:
                w[k] = f"o{seed}x{p}x{side}x{k}"
            out.append(" ".join(w))
    return out


def shingles(text, size=5):
    w = text.split()
    return {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))}


def test_template_family_of_documents(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 40)
    monkeypatch.setattr(neardup, "TASK_SIZE", 20_000)
    texts = template_family(120, own=4, pair_own=3) + template_family(30, own=5, pair_own=3, seed=1)
    texts += [texts[0].replace("t0x1 ", f"n{k} ") for k in range(60)]  # one huge family of near copies amid
    pairs = jaccard_pairs({i: shingles(t) for i, t in enumerate(texts)})
    want = groups(range(len(texts)), pairs)
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert len(pairs) > 200 and len(set(want.values())) > 50
    found = sum(got[a] == got[b] for a, b in pairs)
    assert found >= 0.98 * len(pairs)
    assert groups(range(len(texts)), got.items()) == got and all(want[i] == want[c] for i, c in got.items())


def test_template_family_of_lines(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 40)
    monkeypatch.setattr(neardup, "TASK_SIZE", 20_000)
    r = random.Random(5)
    lines = []
    for family in range(6):
        template = "".join(r.choice("abcdefghijklmnop ") for _ in range(240)).strip()
        for p in range(40):
            places = r.sample(range(6, 230, 12), 3)
            base = list(template)
            for k in places[:2]:
                base[k] = r.choice("QRSTUVWXYZ")
            for _ in range(2):
                x = list(base)
                x[r.choice(range(0, 230, 12))] = r.choice("0123456789")
                lines.append("".join(x).strip())
    lines += ["aaaa " * 30 + "b", "aaaa " * 60 + "b", "aaaa " * 35 + "b"]  # long lines of few distinct shingles
    lines = list(dict.fromkeys(lines))
    sets = {i: fuzzy_lines.shingle_set(x.lower().strip()) for i, x in enumerate(lines)}
    want = groups(sets, jaccard_pairs(sets))
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    removed = {row["doc_id"] for row in fuzzy_lines.fuzzy_line_dedup(docs, least=1).where("n_removed > 0").collect()}
    should = {i for i, c in want.items() if c != i}
    assert len(should) > 100 and len({*want.values()}) > 10
    assert removed <= should and len(removed) >= 0.97 * len(should)


@pytest.mark.parametrize("n", [3, 40])
def test_shared_counts(n):
    g = np.random.default_rng(n)
    sets = [np.unique(g.integers(0, 60, g.integers(0, 30))).astype(np.uint64) for _ in range(n)]
    want = [[len({*a.tolist()} & {*b.tolist()}) for b in sets] for a in sets]
    got = neardup.shared_counts(sets)
    np.fill_diagonal(got, 0)
    want = np.array(want)
    np.fill_diagonal(want, 0)
    assert (got == want).all()


@pytest.mark.parametrize(("name", "spaced"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_encoder_on_random_strings(name, spaced):
    import public_tokenizers
    from tokenizers import Tokenizer

    from tessera.llm.encoding import PieceEncoder

    path = public_tokenizers.path(name)
    tokenizer, encoder, r = Tokenizer.from_file(path), PieceEncoder(path, spaced, max_kept=2000), random.Random(3)
    marks = ["'s", "'", "ll", "²", "½", "٣", "é", "ǅ", "ß", "日本", "한", "_", "-", ".", ",", "...", "<|", "<|endoftext|>", "\t", " ", "　", "\r", "\n", "\n\n", " ", "  ", "😀", "İ", "K", "ﬁ", "ʰ", "\x00", "\x1c"]
    for _ in range(6000):
        text = "".join(r.choice(marks) if r.random() < 0.4 else "".join(r.choice("abTHEéü1") for _ in range(r.randint(1, 5))) + r.choice(["", " ", " "]) for _ in range(r.randint(1, 12)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
