"""Secret scan: fixed patterns, and strings that a primed compressor finds novel in a sensitive context.

A candidate is a run of credential characters shortly after or before a word
such as "password" or "key". Its novelty is the number of bytes it adds to the
zstandard frame of the text around it, the compressor being primed with a
dictionary of identifiers; text that code or prose would predict adds few
bytes, a random string adds nearly its own information.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialize, text_or_empty

# The base kinds in their order, with the group that must reach the least length.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_CHARS, ACCESS_CHARS = 12, 18

# Words whose neighbourhood is sensitive.
SENSITIVE = ("password", "passwd", "passphrase", "pwd", "secret", "token", "credential", "private", "api_key", "apikey", "api key", "auth", "bearer", "signature", "access_key", "client_id", "session", "cookie", "salt", "akia")
SENSITIVE_RE = re.compile("|".join(SENSITIVE), re.I | re.A)

# Identifiers that prime the compressor, after those that the corpus itself uses often.
IDENTIFIERS = " ".join((*SENSITIVE, "username user_name host hostname port database endpoint region bucket config settings environment export import return function class public static final string String const let var self this none null true false None True False http https www com org net json yaml xml request response headers Authorization Content-Type application client server account example localhost default value name key id uuid version path file"))


@dataclass(frozen=True)
class Novelty:
    """How far after a sensitive word a candidate may start or before it end, the text compressed around it, and the least novelty reported."""

    reach: int = 64
    context: int = 256
    min_chars: int = 12
    min_bytes: int = 10
    min_ratio: float = 0.55


#: The least share of the different texts that an identifier must stand in, and most identifiers taken.
COMMON_SHARE, MOST_IDENTIFIERS = 0.01, 2000
#: Most words that a task counts before it passes them on, and most digests of repeated texts sent to all executors.
HELD_WORDS, BROADCAST_TEXTS = 1 << 17, 1_000_000
WORD = re.compile(r"\b[A-Za-z_][A-Za-z0-9_]{2,39}\b", re.A)
#: Long identifiers made of words: small letters, three at least, parted by underscores or capitals.
WORDS = re.compile(r"_*[A-Z]?[a-z]{3,}(?:_+[A-Z]?[a-z]{3,}|[A-Z][a-z]{2,})*_*|_*[A-Z]{3,}(?:_+[A-Z]{3,})*_*")


def each_text_once(docs: DataFrame) -> tuple[DataFrame, int]:
    """``text`` of the different texts that aren't empty, and their number; only texts that stand more than once are gathered."""
    key = F.xxhash64("text").alias("key")
    texts = docs.where("text <> ''").select("text", key)
    keys = materialize(texts.groupBy("key").agg(F.count("*").alias("n")), "keys")
    repeated = keys.where("n > 1").select("key")
    if repeated.count() <= BROADCAST_TEXTS:
        repeated = F.broadcast(repeated)
    copies = texts.join(repeated, "key", "left_semi").select("text").distinct()
    return texts.join(repeated, "key", "left_anti").select("text").unionAll(copies), keys.count()


def common_identifiers(docs: DataFrame, novelty: Novelty = Novelty()) -> list[str]:
    """Words and identifiers of 3 to 40 characters that many of all the different texts of ``docs(text)`` hold, commonest last, where a compressor reaches them at the least cost.

    What could be reported as a secret is never taken, however often it
    stands: a string of ``min_chars`` or more counts only if it is made of
    words and no text has it near a sensitive word.
    """
    texts, number = each_text_once(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        reached: set[str] = set()

        def counted() -> pa.RecordBatch:
            words = [w for w in counts if len(w) < novelty.min_chars or WORDS.fullmatch(w)]
            columns = [pa.array(words, pa.string()), pa.array([counts[w] for w in words], pa.int64()), pa.array([w in reached for w in words], pa.bool_())]
            return pa.RecordBatch.from_arrays(columns, names=["word", "n", "suspect"])

        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update(set(WORD.findall(text)))
                for m in SENSITIVE_RE.finditer(text):
                    near = WORD.findall(text[max(0, m.start() - novelty.reach - 40) : m.end() + novelty.reach + 40])
                    reached.update(w for w in near if len(w) >= novelty.min_chars)
                if len(counts) > HELD_WORDS:
                    yield counted()
                    counts.clear()
                    reached.clear()
        yield counted()

    words = texts.mapInArrow(run, "word string, n long, suspect boolean").groupBy("word").agg(F.sum("n").alias("n"), F.max("suspect").alias("suspect"))
    often = words.where(~F.col("suspect") & (F.col("n") >= F.greatest(F.lit(5), F.lit(COMMON_SHARE * number))))
    return [r["word"] for r in often.orderBy(F.desc("n"), "word").limit(MOST_IDENTIFIERS).collect()][::-1]


class Scanner:
    """Finds ``(start, kind, end)`` spans in code points, end exclusive, sorted by start and then kind in the order of KINDS."""

    def __init__(self, novelty: Novelty = Novelty(), identifiers: list[str] = ()):
        self.novelty = novelty
        self.candidate = re.compile(rf"[A-Za-z0-9+/_.=-]{{{novelty.min_chars},}}")
        primed = zstandard.ZstdCompressionDict((IDENTIFIERS + " " + " ".join(identifiers)).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(level=3)
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=primed)

    def base(self, text: str, sensitive: bool) -> list[tuple[int, int, int]]:
        found = []
        if sensitive:
            found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_CHARS]
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        return found

    def marginal_bytes(self, before: str, candidate: str, after: str) -> int:
        size = lambda s: len(self.compressor.compress(s.encode("utf-8", "replace")))
        return size(before + candidate + after) - size(before + after)

    def novel(self, text: str) -> list[tuple[int, int, int]]:
        n, found, done = self.novelty, [], 0

        def weigh(start: int, end: int) -> None:
            value = text[start:end]
            added = self.marginal_bytes(text[max(0, start - n.context) : start], value, text[end : end + n.context])
            if added >= n.min_bytes and added >= n.min_ratio * len(value):
                found.append((start, 3, end))

        def inside(at: int) -> bool:
            return text[at].isascii() and (text[at].isalnum() or text[at] in "+/_.=-")

        for m in SENSITIVE_RE.finditer(text):
            at = max(done, m.start() - n.reach - n.min_chars)
            while done < at < m.start() and inside(at - 1):
                at -= 1  # the window may have cut the run
            for c in self.candidate.finditer(text, at, max(at, m.start())):
                if c.end() >= m.start() - n.reach:
                    weigh(c.start(), c.end())
            done = max(done, m.end())
            for c in self.candidate.finditer(text, done, min(len(text), m.end() + n.reach + n.min_chars)):
                end = c.end()
                while end < len(text) and inside(end):
                    end += 1  # the window may have cut the run
                done = max(done, end)
                weigh(c.start(), end)
        return found

    def spans(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """Base spans, and all spans."""
        folded = text.lower()
        base = sorted(self.base(text, any(w in folded for w in ("password", "passwd", "secret", "token", "key"))))
        novel = self.novel(text) if any(w in folded for w in SENSITIVE) else []
        return base, sorted(base + novel)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", novelty: Novelty = Novelty()) -> DataFrame:
    """One row per input row: ``doc_id, n_assign, n_access, n_hex, n_novel, base_spans, spans``; spans are ``kind:start:end``, comma-joined.

    Null and empty texts have no spans, no rows give no rows. Rows with equal
    ids or equal texts each give a row; of other columns none is read, so
    their names can't clash. Texts are scanned whole; a task holds one Arrow
    batch and no state, so a lost task is simply run again.
    """
    identifiers = common_identifiers(text_or_empty(df, id_col, text_col), novelty)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(novelty, identifiers)
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                base, spans = scanner.spans(text)
                kinds = [k for _, k, _ in spans]
                rows.append((*(kinds.count(k) for k in range(4)), joined(base), joined(spans)))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:4]), *(pa.array(c, pa.string()) for c in columns[4:])],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_novel", "base_spans", "spans"],
            )

    return text_or_empty(df, id_col, text_col).mapInArrow(scan, "doc_id long, n_assign long, n_access long, n_hex long, n_novel long, base_spans string, spans string")
