"""Secret scan with corpus-wide ownership frequency.

Candidates are found in every whole text and hashed.  For every hash the distinct repositories
and owners that hold it are counted over the corpus: a value copied by many owners, or into many
repositories of few owners, is an example from some manual; any other that looks random is a live
credential.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright.llm.common import chunks, column, free_name, small_batches, stored

# A value held by more owners, or in more repositories, than this is a widely copied example.
MAX_OWNERS, MAX_REPOSITORIES = 2, 20
# Hashes held by more than 1 / HOT of all candidates are broadcast to them.
HOT = 2000
# Shannon entropy, bits a character, from which a value looks random.
MIN_ENTROPY = 3.0
# Kinds of spans in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "jwt", "forge", "pem", "live", "example")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile("AKIA[A-Z0-9]+")
# Runs are maximal, so a lower bound in the pattern drops the same matches as a check after it.
_HEX = re.compile("[0-9a-f]{32,}")
_JWT = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*")
_FORGE = re.compile(r"(?:gh[pousr]_|glpat-|xox[abprs]-|sk_live_)[A-Za-z0-9_-]{16,}")
_PEM = re.compile(
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]*PRIVATE KEY-----)?"
)
_PLACEHOLDER = re.compile("(?i)example|placeholder|changeme|your_|xxxx|0000000000|1234567890")

BASE_KINDS = KINDS[:3]
SPANS_TYPE = "array<struct<start:int,kind:int,end:int>>"
CANDIDATES_TYPE = "array<struct<start:int,end:int,hash:binary,random:boolean>>"
_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
_CANDIDATE = pa.struct(
    [("start", pa.int32()), ("end", pa.int32()), ("hash", pa.binary()), ("random", pa.bool_())]
)


def looks_random(value: str, min_entropy: float = MIN_ENTROPY) -> bool:
    """Whether a value could be a generated credential rather than a word or a placeholder."""
    if _PLACEHOLDER.search(value):
        return False
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    # Sums of logarithms differ in their last bits from one engine to another.
    return entropy >= min_entropy - 1e-9 and any(c in "0123456789" for c in value)


def find_spans(text: str) -> list[tuple[int, int, int, int, int]]:
    """(start, kind, end, start of the value, end of the value), in code points.

    Per kind the leftmost non-overlapping matches of the pattern; assignments with a value of
    fewer than 8 characters and access keys of fewer than 16 are dropped.
    """
    found = []
    lower = text.lower()
    if any(word in lower for word in _ASSIGN_WORDS):
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 8:
                found.append((m.start(), 0, m.end(), m.start(2), m.end(2)))
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= 16:
                found.append((m.start(), 1, m.end(), m.start(), m.end()))
    kinds = [(2, _HEX)]
    if "eyJ" in text:
        kinds.append((3, _JWT))
    if "_" in text or "-" in text:
        kinds.append((4, _FORGE))
    if "-----BEGIN" in text:
        kinds.append((5, _PEM))
    for kind, pattern in kinds:
        for m in pattern.finditer(text):
            found.append((m.start(), kind, m.end(), m.start(), m.end()))
    return sorted(found)


def _scan(
    batches: Iterator[pa.RecordBatch], text_col: str = "text", keep_text: bool = False,
    names: tuple[str, str] = ("spans", "candidates"),
) -> Iterator[pa.RecordBatch]:
    """Rows with their spans and the candidates among them, hashed."""
    for batch, texts in chunks(batches, text_col):
        spans, candidates = [], []
        for text in texts:
            found = find_spans(text) if text else []
            spans.append([{"start": s, "kind": k, "end": e} for s, k, e, _, _ in found])
            # One value may be found as several kinds; it is one candidate.
            values = {(a, b): text[a:b] for _, _, _, a, b in found}
            candidates.append([
                {
                    "start": a,
                    "end": b,
                    "hash": hashlib.sha256(value.encode()).digest()[:16],
                    "random": looks_random(value),
                }
                for (a, b), value in sorted(values.items())
            ])
        kept = [name for name in batch.schema.names if keep_text or name != text_col]
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(batch.schema.get_field_index(name)) for name in kept],
                pa.array(spans, pa.list_(_SPAN)),
                pa.array(candidates, pa.list_(_CANDIDATE)),
            ],
            names=[*kept, *names],
        )


def _with_spans(
    rows: DataFrame, text_col: str, keep_text: bool, names: tuple[str, str], label: str
) -> DataFrame:
    """Scan every text once, and write the rows with what was found."""
    schema = T.StructType([
        *[f for f in rows.schema.fields if keep_text or f.name != text_col],
        T.StructField(names[0], T._parse_datatype_string(SPANS_TYPE)),
        T.StructField(names[1], T._parse_datatype_string(CANDIDATES_TYPE)),
    ])
    return stored(rows.mapInArrow(lambda b: _scan(b, text_col, keep_text, names), schema), label)


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, owners, repositories, held) of rows (hash, owner, repository): exact distinct
    counts, and the number of rows.

    Three aggregations that each combine before they shuffle, so a value held by a third of all
    documents is counted in every task that reads it.  A null owner (repository) is one owner.
    """
    return (
        candidates.groupBy("hash", "owner", "repository").agg(F.count("*").alias("held"))
        .groupBy("hash", "owner").agg(F.count("*").alias("repositories"), F.sum("held").alias("held"))
        .groupBy("hash").agg(
            F.count("*").alias("owners"), F.sum("repositories").alias("repositories"),
            F.sum("held").alias("held"),
        )
    )


def _verdicts(found: DataFrame, max_owners: int, max_repositories: int, hot: int = HOT) -> DataFrame:
    """(row, judged): the spans of kind live or example, of stored rows (row, owner, repository,
    candidates).

    The fewer than ``hot`` hashes that more than 1 / ``hot`` of the candidates hold are broadcast;
    all others meet their candidates by a shuffle without a hot key.
    """
    candidates = found.select("row", F.explode("candidates").alias("c"), "owner", "repository").select(
        "row", "c.start", "c.end", "c.hash", "c.random", "owner", "repository"
    )
    counts = stored(ownership(candidates), "secret_owners")
    total = counts.agg(F.sum("held")).first()[0] or 0
    often = F.broadcast(counts.filter(F.col("held") * hot > total))
    seldom = counts.filter(F.col("held") * hot <= total)
    met = candidates.join(often, "hash").unionByName(
        candidates.join(often.select("hash"), "hash", "left_anti").join(seldom, "hash")
    )
    copied = (F.col("owners") > max_owners) | (F.col("repositories") > max_repositories)
    kind = F.when(copied, KINDS.index("example")).when(F.col("random"), KINDS.index("live"))
    return (
        met.select("row", F.struct("start", kind.alias("kind"), "end").alias("span"))
        .filter(F.col("span.kind").isNotNull())
        .groupBy("row").agg(F.collect_list("span").alias("judged"))
    )


def _none() -> Column:
    return F.lit([]).cast(SPANS_TYPE)


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repository_col: str = "doc_id",
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """(row, doc_id, spans): all spans of every row, sorted by start, kind and end.

    ``spans`` is an array of (start, kind, end) with kinds as indexes into ``KINDS``.  To the
    spans of the patterns come, for every value, ``example`` where more than ``max_owners``
    owners hold it or more than ``max_repositories`` repositories (counted per owner) do, and
    ``live`` where no more do and it looks random.  ``row`` numbers the rows of ``docs``: the
    numbers are written once, with what was found, and every later pass reads those.

    Texts are scanned once and never shuffled: only hashes meet.  Null and empty texts have no
    spans.  Repeated rows and ids stay separate rows; repeated rows of one owner and repository
    count once.  No rows give no rows.  Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    found = _with_spans(docs.select(
        F.monotonically_increasing_id().alias("row"),
        column(id_col).alias("doc_id"),
        column(text_col).alias("text"),
        column(owner_col).alias("owner"),
        column(repository_col).alias("repository"),
    ), "text", False, ("spans", "candidates"), "secret_spans")
    verdicts = _verdicts(
        found.select("row", "owner", "repository", "candidates"), max_owners, max_repositories
    )
    return found.select("row", "doc_id", "spans").join(verdicts, "row", "left").select(
        "row", "doc_id",
        F.array_sort(F.concat("spans", F.coalesce("judged", _none()))).alias("spans"),
    )


def spans_text(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the spans of the given kinds, comma-joined in their order."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    wanted = F.filter(spans, lambda s: names[s["kind"]].isin(*kinds))
    return F.concat_ws(",", F.transform(wanted, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))))


def _mask(text: str, spans: list[dict]) -> str:
    """Replace the union of overlapping spans; one that holds a live value is a secret."""
    example, out, at = KINDS.index("example"), [], 0
    merged: list[list] = []
    for span in sorted(spans, key=lambda s: (s["start"], s["end"])):
        kinds = {span["kind"]}
        if merged and span["start"] < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], span["end"])
            merged[-1][2] |= kinds
        else:
            merged.append([span["start"], span["end"], kinds])
    for start, end, kinds in merged:
        out += [text[at:start], "[EXAMPLE]" if example in kinds else "[SECRET]"]
        at = end
    return "".join([*out, text[at:]])


def mask(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repository_col: str = "doc_id",
    length_col: str | None = "n_chars",
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """``docs`` with secrets masked: ``[SECRET]``, or ``[EXAMPLE]`` for widely copied values.

    Columns, of whatever names, and rows stay as they are; ``length_col`` follows the new text.
    Texts are scanned once, and written with their spans; only those with spans are moved (to
    meet the verdicts), all others stay in their task.
    """
    small_batches(docs.sparkSession)
    order = docs.columns
    row, spans, hashes, judged = (
        free_name(docs, name) for name in ("__row", "__spans", "__candidates", "__judged")
    )
    whole = _with_spans(
        docs.withColumn(row, F.monotonically_increasing_id()), text_col, True, (spans, hashes),
        "secret_rows",
    )
    verdicts = _verdicts(whole.select(
        F.col(row).alias("row"),
        column(owner_col).alias("owner"),
        column(repository_col).alias("repository"),
        F.col(hashes).alias("candidates"),
    ), max_owners, max_repositories).select(F.col("row").alias(row), F.col("judged").alias(judged))
    hit = F.size(spans) > 0
    met = whole.filter(hit).join(verdicts, row, "left").select(
        *[column(c) for c in order],
        F.concat(spans, F.coalesce(judged, _none())).alias(spans),
    )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = order.index(text_col)
            texts = [
                _mask(text, found)
                for text, found in zip(
                    batch.column(at).to_pylist(), batch.column(len(order)).to_pylist(), strict=True
                )
            ]
            columns = [*batch.columns[:at], pa.array(texts, pa.string()), *batch.columns[at + 1:]]
            yield pa.RecordBatch.from_arrays(columns[:len(order)], names=order)

    masked = met.mapInArrow(apply, docs.schema)
    length = [f.dataType for f in docs.schema.fields if f.name == length_col]
    if length:
        masked = masked.withColumn(
            length_col, F.when(column(length_col).isNotNull(), F.length(column(text_col)))
            .cast(length[0])
        ).select(*[column(c) for c in order])
    return whole.filter(~hit).select(*[column(c) for c in order]).unionByName(masked)
