"""Secrets in texts: three base kinds by pattern, and random strings by token efficiency.

A byte-pair vocabulary spends few tokens on what people write and many on random strings. So a long run of characters with
few characters per token under a public vocabulary is taken for a secret, unless it is a known digest or an identifier:
hexadecimal digests of the usual lengths, labelled digests, UUIDs, plain numbers and parts of addresses. Everything is decided
within a row, in one pass over the text and without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from haulage.llm.base import id_back, id_text, in_slices, query, table, whole_text
from haulage.llm.words import kept_with

#: Base kinds as listed, then the kind of the method.
KINDS = ("assign", "access", "hex")
RANDOM = "random"
#: A run from this length is weighed; below these characters per token it is random: with letters and digits or letters of
#: both cases mixed, or of one case only, where invented words come closer to randomness.
LEAST_CHARS, MIXED, PLAIN = 20, 1.9, 1.45
#: Characters that are encoded in one piece; the tokens of a longer run are counted piece by piece.
PIECE = 2048

_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_KEYWORDS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_UUID = re.compile(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}")
#: Lengths of hexadecimal digests (fixed values): 128, 160, 224, 256, 384 and 512 bits.
_DIGEST_CHARS = (32, 40, 56, 64, 96, 128)
_LABEL = re.compile(r"(?:md5|sha-?(?:1|224|256|384|512)|blake2[bs]|crc32|etag|commit|integrity|checksum|digest)[\"']?\x20*[:=-]?\x20*[\"']?$", re.I | re.A)
_OWN_LABEL = re.compile(r"(?:md5|sha(?:1|224|256|384|512))[-=_]", re.I | re.A)

SPANS = "array<struct<start:long,rank:int,end:long,kind:string>>"


def token_counter(vocabulary: str):
    """A function that counts the tokens of a text; ``vocabulary`` is a tiktoken file."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encode = tiktoken.Encoding("scan", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return lambda text: sum(len(encode(text[i:i + PIECE])) for i in range(0, len(text), PIECE))


def known(run: str, before: str, after: str) -> bool:
    """Whether a run is a digest or an identifier: by its shape, or by what stands around it."""
    bare = run.strip("+/_=-")
    if bare.isdigit() or re.fullmatch(r"[0-9]+(?:[-_/+=][0-9]+)+", bare) or _UUID.fullmatch(bare) or _OWN_LABEL.match(bare):
        return True
    if len(bare) in _DIGEST_CHARS and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", bare):
        return True
    return after == "@" or before.endswith("@") or _LABEL.search(before) is not None


def is_random(run: str, tokens) -> bool:
    """Whether the vocabulary spends so many tokens on the run that nobody can have written it."""
    digits, upper, lower = (any(f(c) for c in run) for f in (str.isdigit, str.isupper, str.islower))
    inner_upper = lower and any(c.isupper() for c in run[1:])
    least = MIXED if digits and (upper or lower) or inner_upper else PLAIN
    return len(run) < least * tokens(run)


def spans_of(text: str, tokens) -> list[tuple[int, int, int, str]]:
    """(start, rank, end, kind) of every span of a text, in order; ranks follow the kinds as listed."""
    found = []
    if any(k in text.lower() for k in _KEYWORDS):
        found += [(m.start(), 0, m.end(), KINDS[0]) for m in _ASSIGN.finditer(text) if m.end() - m.start(1) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), KINDS[1]) for m in _ACCESS.finditer(text)]
    runs = [(m.start(), m.group()) for m in _RUN.finditer(text)]
    found += [(at + m.start(), 2, at + m.end(), KINDS[2]) for at, run in runs for m in _HEX.finditer(run)]
    base = sorted(found)
    for at, run in runs:
        end = at + len(run)
        if len(run) >= LEAST_CHARS and not any(s < end and at < e for s, _, e, _ in base):
            if not known(run, text[max(0, at - 24):at], text[end:end + 1]) and is_random(run, tokens):
                found.append((at, 3, end, RANDOM))
    return sorted(found)


def secrets(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, spans) for every row of ``(doc_id, text)``; a span has start, rank, end and kind.

    Places are code points, ends exclusive. Base kinds: ``assign``, ``access`` and ``hex`` by pattern; ``random`` are runs of
    at least ``LEAST_CHARS`` characters with few characters per token that no base span touches. Null and empty texts have no
    spans; texts of any length are looked through whole; repeated rows and rows without an id are each answered; no rows give no
    rows. Other columns are not looked at.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        tokens = kept_with(tiktoken, f"scan {vocabulary}", lambda: token_counter(vocabulary))
        for frame in in_slices(batches):
            spans = [[{"start": s, "rank": r, "end": e, "kind": k} for s, r, e, k in spans_of(t, tokens)] for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"].to_numpy(), "spans": spans})

    texts = docs.select(id_text("doc_id"), whole_text().alias("text"))
    return id_back(texts.mapInPandas(run, f"doc_id string, spans {SPANS}"), "doc_id")


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def report(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, counts and digest of the base spans, and all spans, for every row of ``(doc_id, text)``; see ``secrets``."""
    base = F.filter("spans", lambda s: s["rank"] < len(KINDS))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return secrets(docs, vocabulary).select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"), count(RANDOM).alias("n_random"))


def byte_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@query("op13_secrets")
def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents", "doc_id", "text"), byte_vocabulary())
