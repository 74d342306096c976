"""Kernels against brute force, and cases with nulls, repeats, clashing names and hot keys."""

import collections
import random

import corpus_pipeline
import numpy as np
import public_tokenizers as P
import regex
import zstandard

from tessera.llm import decontaminate, fuzzy_lines, neighbours, packing, secrets, toxicity
from tests.llm.test_operators import prose


def spans_by_hand(text):
    """The base spans found place by place, without the operator's patterns."""
    found = []
    word = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_.=-"

    def run(at, letters):
        end = at
        while end < len(text) and text[end] in letters:
            end += 1
        return end

    def assign(at):
        for name in ("password", "passwd", "secret", "token", "apikey", "api_key"):
            if all(c.isascii() for c in text[at : at + len(name)]) and text[at : at + len(name)].lower() == name:
                for quote in (1, 0):
                    p = at + len(name)
                    if quote and text[p : p + 1] not in ('"', "'"):
                        continue
                    p = run(p + quote, " ")
                    if text[p : p + 1] not in (":", "="):
                        continue
                    p = run(p + 1, " ")
                    p += text[p : p + 1] in ('"', "'") and p < len(text)
                    if run(p, word) > p:
                        return p, run(p, word)
        return None

    at = 0
    while at < len(text):
        if m := assign(at):
            if m[1] - m[0] >= 12:
                found.append((at, 0, m[1]))
            at = m[1]
        else:
            at += 1
    for kind, head, letters, least in ((1, "AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 18), (2, "", "0123456789abcdef", 16)):
        at = 0
        while at < len(text):
            end = run(at + len(head), letters) if text.startswith(head, at) else at
            if end > at + len(head):
                if end - at >= least:
                    found.append((at, kind, end))
                at = end
            else:
                at += 1
    return sorted(found)


def test_base_spans_of_random_strings():
    r, scanner = random.Random(8), secrets.Scanner()
    parts = ["password", "PassWd", "secret", "token", "api_key", "apiKEY", "toKen", "ſecret", ":", "=", " ", "  ", "'", '"', "\n", "AKIA", "AKIAX", "deadbeef", "0123456789abcdef", "A1B2C3D4E5F6G7H8", "aB3+/_.=-", "é", "x"]
    for _ in range(4000):
        text = "".join(r.choice(parts) for _ in range(r.randint(1, 14)))
        folded = text.lower()
        assert sorted(scanner.base(text, True)) == spans_by_hand(text), repr(text)
        assert scanner.spans(text)[0] == spans_by_hand(text), repr(folded)


def test_novelty_is_a_difference_of_frames():
    identifiers = ["request", "handler"]
    raw = (secrets.IDENTIFIERS + " " + " ".join(identifiers)).encode()
    c = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
    scanner, r = secrets.Scanner(secrets.Novelty(), identifiers), random.Random(2)
    for _ in range(200):
        before, after = prose(20, r.random()), prose(10, r.random())
        value = "".join(r.choice("abcXYZ0189+/") for _ in range(r.randint(12, 60)))
        want = len(c.compress((before + value + after).encode())) - len(c.compress((before + after).encode()))
        assert abs(scanner.marginal_bytes(before, value, after) - want) <= 4
    assert scanner.marginal_bytes("the ", "request_handler_request", " is") < scanner.marginal_bytes("the ", "q7XvK2mZr9LpT4wBn8YcD1e", " is")


def test_identifiers_come_from_many_documents(spark):
    secret = "XqZkPwLmNvBtRyHs"
    rows = [(i, f"def frobnicate_widget(): {prose(20, i)}", "", "") for i in range(60)] + [(100 + i, f"the password is {secret}", "s", "n") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_assign string")
    common = secrets.common_identifiers(docs)
    assert "frobnicate_widget" in common and secret not in common
    found = {r["doc_id"]: r["spans"] for r in secrets.scan_secrets(docs).collect()}
    assert found[100] == found[159] == "novel:16:32" and found[3] == ""
    assert secrets.scan_secrets(docs.where("false")).count() == 0
    short = secrets.Scanner(secrets.Novelty(min_chars=8, min_bytes=6)).novel("password is aB3xZ9qK now")
    assert short == [(12, 3, 20)]


def test_repeated_secret_is_reported_everywhere(spark):
    """A random token in 12 of 200 different texts stays out of the dictionary, whatever its letters; one in a single text is found as well."""
    for token in ("q7XvK2mZr9LpT4wBn8YcD1eHj5S", "qwzkxvbnmplkjhgfdsaqwrtypsdf"):
        rows = [(i, f"{prose(30, i)} the token is {token} {prose(20, 900 + i)}" if i < 12 else prose(50, i)) for i in range(200)] + [(300, f"{prose(30, 300)} the password is {token[::-1]} here")]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        assert token not in secrets.common_identifiers(docs)
        found = {r["doc_id"]: r["n_novel"] for r in secrets.scan_secrets(docs).collect()}
        assert all(found[i] >= 1 for i in [*range(12), 300])


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_lexicon_against_edit_distance():
    r = random.Random(5)
    words = sorted({"".join(r.choice("abc") for _ in range(r.choice([2, 3, 4, 5, 6, 9, 40]))) for _ in range(150)})
    terms = {w: float(k + 1) for k, w in enumerate(words)}
    lexicon = toxicity.Lexicon([("=" + w, v) for w, v in terms.items()])
    asked = {w[:k] + c + w[k + d :] for w in words for _ in range(6) for k in [r.randrange(len(w) + 1)] for d in [r.randint(0, 1)] for c in [r.choice(["", "a", "b", "d"])]}
    for w in asked | {"", "a", "ab" * 30}:
        near = max((v for t, v in terms.items() if len(t) >= toxicity.MISSPELT_CHARS and edit_distance(w, t) == 1), default=0.0)
        want = (terms[w], 0) if w in terms else (near, 1) if near else (0.0, None)
        got = lexicon.lookup(w)
        assert got[0] == want[0] and (not want[0] or got[1] == want[1]), w


def test_vectors_far_from_the_origin(spark):
    x = np.random.default_rng(6).normal(size=(400, 8)) + 1e8
    rows = [(i, v.tolist(), "n", 1) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string, leaf int")
    got = collections.defaultdict(list)
    for r in neighbours.nearest(df, sample_rows=200, leaf_rows=100, block_rows=50).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    found = 0
    for q, near in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        found += len({*near} & {int(i) for i in np.lexsort((np.arange(400), d)) if i != q} & {int(i) for i in np.argsort(d)[:11]})
    assert sorted(got) == [0, 100, 200, 300] and found >= 36


def test_rows_without_id_are_dealt_to_many_groups(spark, tmp_path):
    rows = spark.range(6000).selectExpr("cast(null as long) as doc_id", "0L as start", "1L + id % 2000 as length", "'x' as pack_group0")
    rows.write.parquet(f"{tmp_path}/p")
    placed = packing.pack(spark.read.parquet(f"{tmp_path}/p"), 2048, group_size=500).collect()
    assert len(placed) == 6000 and len({r["sequence_id"] >> 32 for r in placed}) == 12
    used = collections.Counter()
    for r in placed:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 2048 and sum(used.values()) / len(used) > 0.9 * 2048


def test_items_without_id(spark):
    docs = spark.createDataFrame([(1, prose(30, 1), "i"), (None, "zz " + prose(30, 1), "i"), (2, prose(30, 9), "i")], "doc_id long, text string, item string")
    items = spark.createDataFrame([(None, prose(12, 1)), (None, None)], "item_id string, text string")
    got = {r["doc_id"]: (r["contaminated"], r["items"]) for r in decontaminate.decontaminate(docs, items).collect()}
    assert got == {1: (True, [""]), None: (True, [""]), 2: (False, [])}


def test_lines_with_clashing_names_and_long_lines(spark):
    line = prose(5000, 3).replace("\n", " ")
    rows = [(1, line, 0, "a", "b"), (2, line + " more", 0, "a", "b"), (3, "own words of this one", 0, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int, removed string, left string")
    left = fuzzy_lines.without_repeated_lines(docs)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {1, 3}
    assert left.where("doc_id = 1").first()["left"] == "b"


def test_stages_with_odd_rows(spark, tmp_path):
    texts = [(i, prose(60, 700 + i).replace("\n", " ")) for i in range(30)]
    passage = " ".join(texts[5][1].split()[3:25])
    rows = [*texts, texts[0], (7, "other words of the same id " + prose(40, 99).replace("\n", " ")), (8, passage), (None, prose(50, 4)), (None, None), (9, "")]
    docs = spark.createDataFrame([(i, t, "theirs", "r") for i, t in rows], "doc_id long, text string, score string, row string")
    spark.createDataFrame([("b", passage)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, int(i > 25)) for i in range(30)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for at in (docs, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES[:4]:
            out = stage(spark, at, str(tmp_path))
            assert out.columns == docs.columns, name
            if at is not docs:
                assert out.count() == 0
        assert stage is corpus_pipeline.drop_contaminated
    assert {r["score"] for r in corpus_pipeline.reject_toxic(spark, docs, str(tmp_path)).collect()} == {"theirs"}
    clean = collections.Counter(r["doc_id"] for r in corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)).collect())
    assert clean[5] == 0 and clean[8] == 1 and clean[None] == 2 and clean[0] == 2
    deduped = collections.Counter(r["doc_id"] for r in corpus_pipeline.dedup_documents(spark, docs, str(tmp_path)).collect())
    assert all(deduped[i] == (2 if i in (7, 8, 9) else 1) for i in range(30)) and deduped[None] == 2  # other texts of one id are other documents
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/plain")
    plain = spark.read.parquet(f"{tmp_path}/plain")
    assert corpus_pipeline.dedup_lines(spark, plain, str(tmp_path)).count() == 30
    assert regex.fullmatch(r"\d+", str(corpus_pipeline.pack(spark, plain, str(tmp_path)).count())) and P.path("byte_bpe_50k.json")


def test_identifiers_are_counted_in_every_text(spark, monkeypatch):
    """Of 6,000 texts none is left out: a word in just 1 % of them is taken, one in a text less is not, equal texts count once, and one text near a sensitive word keeps a word out."""
    texts = [f"n{i}" + " quokka_herder" * (i % 100 == 0) + " wombat" * (i % 100 == 1 and i > 1) + " lyrebirds_everywhere" * (i % 50 == 2) for i in range(5999)]
    texts += ["the password is lyrebirds_everywhere"] + ["a wombat here"] * 300 + [None, ""]
    docs = secrets.text_or_empty(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text")
    for held, sent in ((secrets.HELD_WORDS, secrets.BROADCAST_TEXTS), (500, -1)):
        monkeypatch.setattr(secrets, "HELD_WORDS", held)
        monkeypatch.setattr(secrets, "BROADCAST_TEXTS", sent)
        once, number = secrets.each_text_once(docs)
        assert number == 6001 == once.count() == once.distinct().count()
        common = secrets.common_identifiers(docs.where("text <> 'n1'"))
        assert "quokka_herder" in common and "lyrebirds_everywhere" not in common
        assert "wombat" in common  # 59 texts, and one that stands 300 times
    assert "wombat" not in secrets.common_identifiers(docs.where("text <> 'a wombat here'"))
