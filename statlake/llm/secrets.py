"""Secret scan: patterns plus a token-efficiency test (operator 2).

Three fixed patterns find assignments, access keys and hex strings.  A run of
key characters that no pattern caught is tested for token efficiency: a BPE
vocabulary packs ordinary text at well over two characters a token, random
strings at little over one.  Segments between dots are runs of their own; a run
that is not random as a whole, or is part of a URL's path, is tested piece by
piece between slashes.  Left out before the test are pieces that are wholly a
known digest (hex of a digest's length), a UUID or a number, the host of a URL
and both parts of an e-mail address; user and password of a URL are tested.  A
run that a pattern caught only in part is tested as a whole.

The vocabulary file (``.tiktoken`` ranks, a parameter) is read once on the
driver and broadcast: its size is that of the file, under 1 MB.

Defined cases: null text is empty and has no spans; repeated rows give a row
each; other columns are not read.  Offsets are code points, end exclusive.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlake.llm import store

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed: how text is cut before byte pairs are merged (the vocabulary's published pattern).
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Fixed: kinds in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
RUN = re.compile(r"[A-Za-z0-9_+/-]{16,}={0,2}")
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
#: user and password of a URL, if any, and its host; the domain of an e-mail address
URL = re.compile(r"://([^\s/?#@]*@)?([^\s/?#@:]+)")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
TOP = re.compile(r"[A-Za-z]{2,24}")
SHORTEST = 16
ANY_HEX = re.compile(r"[0-9A-Fa-f]+")
NUMBER = re.compile(r"[0-9+/_-]+=*")
#: Fixed: hex lengths of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGEST_LENGTHS = frozenset((32, 40, 56, 64, 96, 128))
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType())]))


def load_vocabulary(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The three patterns' matches."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return out


def known(run: str) -> bool:
    """Whether a run is wholly a digest, a UUID or a number."""
    return bool((ANY_HEX.fullmatch(run) and len(run) in DIGEST_LENGTHS) or UUID.fullmatch(run) or NUMBER.fullmatch(run))


def addresses(text: str) -> list[tuple[int, int]]:
    """Hosts of URLs and e-mail addresses."""
    out, users = [], set()
    if "://" in text:
        for m in URL.finditer(text):
            out.append(m.span(2))
            users.add(m.end(1) - 1)
    if "@" in text:
        for m in DOMAIN.finditer(text):
            at = m.start()
            s = at
            while s and at - s <= 64 and text[s - 1] in LOCAL:
                s -= 1
            # a local part has 64 characters at most; what follows a colon is a password
            if at not in users and 0 < at - s <= 64 and (text[s - 1:s] != ":" or text[max(0, s - 7):s].lower() == "mailto:"):
                out.append((s, m.end()))
    return out


class Cover:
    """Tells whether given spans cover, or touch, a stretch of text."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts, self.ends = [], []
        for s, e in sorted(spans):
            if self.ends and s <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def covers(self, s: int, e: int) -> bool:
        i = bisect_right(self.starts, s) - 1
        return i >= 0 and e <= self.ends[i]

    def touches(self, s: int, e: int) -> bool:
        i = bisect_right(self.starts, e - 1) - 1
        return i >= 0 and s < self.ends[i]


class Scanner:
    """Finds the spans of one text.  ``ratio``: characters a token up to which
    a run with digits counts as random; ``letters_ratio``: the same without digits."""

    def __init__(self, ranks: dict[bytes, int], ratio: float, letters_ratio: float):
        import tiktoken
        self.encode = tiktoken.Encoding("scan", pat_str=PIECES, mergeable_ranks=ranks,
                                        special_tokens={}).encode_ordinary
        self.ratio, self.letters_ratio, self.seen = ratio, letters_ratio, {}

    def random(self, run: str) -> bool:
        hit = self.seen.get(run)
        if hit is None:
            limit = self.ratio if any("0" <= c <= "9" for c in run) else self.letters_ratio
            # the encoder's time grows faster than a run's length: long runs are cut into pieces of 64
            tokens = sum(len(self.encode(run[i:i + 64])) for i in range(0, len(run), 64))
            hit = len(run) <= limit * tokens
            if len(self.seen) >= 100_000:
                self.seen.clear()
            self.seen[run] = hit
        return hit

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        out = base_spans(text)
        taken, hosts = Cover([(s, e) for _, s, e in out]), None
        for m in RUN.finditer(text):
            s, e = m.span()
            if taken.covers(s, e):
                continue
            if hosts is None:
                hosts = Cover(addresses(text))
            out += [("random", a, b) for a, b in self.within(text, s, e, taken, hosts)]
        return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))

    def within(self, text: str, s: int, e: int, taken: Cover, hosts: Cover) -> list[tuple[int, int]]:
        """The run itself if it is random, else its random pieces between slashes."""
        run = text[s:e]
        if "/" not in run:
            return [(s, e)] if not (known(run) or hosts.touches(s, e)) and self.random(run) else []
        pieces, at = [], s
        for part in run.split("/"):
            pieces.append((at, at + len(part)))
            at += len(part) + 1
        path = hosts.touches(s, e)
        if run.startswith("//"):
            path = True
            if text[max(0, s - 1):s] != ":" and text[e:e + 1] == ".":  # a host without a scheme
                pieces = []
        elif text[max(0, s - 1):s] == "." and TOP.fullmatch(run, 0, pieces[0][1] - s):
            path, pieces = True, pieces[1:]  # host.com/path
        same = [known(text[a:b]) or taken.covers(a, b) for a, b in pieces]
        if not path and not known(run) and not any(x and b - a >= SHORTEST for x, (a, b) in zip(same, pieces, strict=True)) and self.random(run):
            return [(s, e)]
        return [(a, b) for x, (a, b) in zip(same, pieces, strict=True)
                if not x and b - a >= SHORTEST and not hosts.touches(a, b) and self.random(text[a:b])]


def scan_secrets(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY, ratio: float = 1.8,
                 letters_ratio: float = 1.45, out: str = "spans", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all, by default) and ``out``: array of (kind, start, end)."""
    ranks = docs.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary))
    names = list(docs.columns if keep is None else keep)
    slim = docs.select(*[F.col(f"`{c}`") for c in names], F.col(text_col).alias("_scan_text"))
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches):
        scanner = Scanner(ranks.value, ratio, letters_ratio)
        for b in batches:
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in scanner.spans(t)] if t else []
                     for t in (x.as_py() for x in b.column(b.num_columns - 1))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(found, span)], [*names, out])
    schema = T.StructType([*docs.select(*[F.col(f"`{c}`") for c in names]).schema.fields, T.StructField(out, SPANS)])
    return slim.mapInArrow(scan, schema)


def redact(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with every secret replaced by its kind in brackets; hex of a
    digest's length is no secret and stays, unless it is part of a random run.
    Other columns, of any name, are carried as they are."""
    d, at = store.renamed(docs)
    d = scan_secrets(d, at[text_col], out="_spans", **options)
    hide = F.filter("_spans", lambda s: ~((s["kind"] == "hex") & (s["end"] - s["start"]).isin(*sorted(DIGEST_LENGTHS))))
    d = d.withColumn("_hide", hide)
    text = F.col(at[text_col])
    # overlapping spans: each starts where the ones before it have ended
    cut = F.aggregate("_hide", F.struct(F.lit("").alias("t"), F.lit(0).cast("long").alias("at")), lambda acc, s: F.struct(
        F.when(s["start"] >= acc["at"], F.concat(acc["t"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                                                 F.lit("["), s["kind"], F.lit("]"))).otherwise(acc["t"]).alias("t"),
        F.greatest(acc["at"], s["end"]).alias("at")),
        lambda acc: F.concat(acc["t"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    clean = F.when(F.size("_hide") > 0, cut).otherwise(text)
    return store.named_back(d.withColumn(at[text_col], clean), at)


def op2_query(docs: DataFrame, **options) -> DataFrame:
    found = scan_secrets(docs, keep=["doc_id"], **options)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    text = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(text(base), 256).alias("base_sha256"),
                        text(F.col("spans")).alias("spans"), count("random").alias("n_random"))


def brute_force(text: str | None) -> tuple[int, int, int, str]:
    """The base columns by the plain patterns, for tests."""
    text, found = text or "", []
    for kind, pattern, group, least in (("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", re.compile("[0-9a-f]+"), 0, 24)):
        found += [(m.start(), KINDS.index(kind), m.end()) for m in pattern.finditer(text) if len(m[group]) >= least]
    n = [sum(k == i for _, k, _ in found) for i in range(3)]
    joined = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(found))
    return (*n, hashlib.sha256(joined.encode()).hexdigest())
