"""Documents, measured in tokens, into containers of fixed capacity.

Vector best fit: a container has residual tokens, a residual number of documents and a residual attention cost (the sum
of the squared piece lengths). Pieces are placed longest first, each into the open container that has room under every
constraint and leaves the smallest weighted norm of residuals, or whose residuals have the largest weighted dot product
with the piece's demand. A piece that alone costs more than containers may is one by itself. Only documents longer than a
container are cut.

Containers are filled within groups of about GROUP documents, drawn by hash, which are independent tasks; a group leaves
at most a few containers badly filled, so what is lost against one global packing doesn't grow with the data.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.plans.runtime import cut

#: Where the ranks of a public byte-level vocabulary lie on the driver, and the way it splits text (a fixed value).
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
GROUP = 20_000
#: The attention cost of a container, as a share of what a single piece of its capacity has.
COST = 0.5
#: Texts are encoded in slices of about so many characters, cut where a word ends, which no token crosses.
SLICE = 100_000
_WORD_END = re.compile(r"(?<=\S)(?=\s)")


def slices(text: str) -> Iterator[str]:
    """The text in parts that end where white space begins after a word."""
    start = 0
    while len(text) - start > SLICE:
        m = _WORD_END.search(text, start + SLICE)
        if not m:
            break
        yield text[start : m.start()]
        start = m.start()
    yield text[start:] if start else text


def token_counts(df: DataFrame, key: Column, text: Column, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, n_tokens) of every row with a text. The vocabulary (of ``tokenizer``, else of the session's setting
    spark.lexweave.tokenizer, else TOKENIZER) is read once by the driver and sent to the executors."""
    with open(tokenizer or df.sparkSession.conf.get("spark.lexweave.tokenizer", TOKENIZER), "rb") as f:
        ranks = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.value.splitlines())}
        encode = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=table, special_tokens={}).encode_ordinary
        for b in batches:
            n = [sum(len(encode(part)) for part in slices(t.as_py())) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])

    return df.select(key.cast("bigint").alias("doc_id"), text.alias("t")).where("doc_id is not null and t is not null").mapInArrow(run, "doc_id bigint, n_tokens bigint")


def best_fit(tokens: np.ndarray, capacity: int, max_docs: int, max_cost: float, weights: tuple[float, float, float] = (1.0, 0.05, 0.2), rule: str = "norm") -> np.ndarray:
    """The container of each piece, numbered from 0; ``tokens`` in falling order, none above ``capacity``."""
    n = len(tokens)
    out = np.empty(n, np.int64)
    limit = np.array([capacity, max_docs, max_cost], float)
    w = np.array(weights)
    left = np.empty((1024, 3))
    ids = np.empty(1024, np.int64)
    m = made = 0
    small = float(tokens[-1]) if n else 0.0
    least = np.array([small, 1, small * small]) / limit - 1e-12
    for i, t in enumerate(tokens):
        need = np.array([t, 1, float(t) * t]) / limit
        at = -1
        if m:
            rest = left[:m] - need
            fits = np.flatnonzero(rest.min(axis=1) >= -1e-12)
            if len(fits):
                score = (rest[fits] ** 2) @ w if rule == "norm" else -(left[fits] @ (w * need))
                at = fits[np.argmin(score)]
        if at < 0:
            if m == len(ids):
                left, ids = np.resize(left, (2 * m, 3)), np.resize(ids, 2 * m)
            left[m], ids[m] = 1.0, made
            at, m, made = m, m + 1, made + 1
        left[at] -= need
        out[i] = ids[at]
        if (left[at] < least).any():  # full for even the shortest piece: take it out of the search
            m -= 1
            left[at], ids[at] = left[m], ids[m]
    return out


def pack(counts: DataFrame, capacity: int = 2048, max_docs: int = 64, max_cost: float | None = None, rule: str = "norm", group: int = GROUP) -> DataFrame:
    """(container, doc_id, piece, n_pieces, first_token, n_tokens): every piece of every document and its container.

    A piece is at most ``capacity`` tokens; a document within that is one piece. The squared lengths of the pieces that
    share a container add up to at most ``max_cost`` (by default COST of the capacity squared); a piece beyond that by
    itself has a container for itself. Documents without tokens need no place and are left out. Rows are items: a
    document given twice is placed twice. Ties go by doc_id, so the result depends on nothing but the input. An empty
    table gives no containers.
    """
    cost = max_cost or COST * capacity * capacity
    items = cut(counts.select("doc_id", F.col("n_tokens").cast("bigint").alias("n_tokens")).where("n_tokens > 0"))
    groups = max(1, -(-items.count() // group))
    pieces = items.withColumn("n_pieces", F.ceil(F.col("n_tokens") / capacity).cast("int"))
    pieces = pieces.select("doc_id", "n_tokens", "n_pieces", F.explode(F.sequence(F.lit(1), F.col("n_pieces"))).alias("piece"))
    pieces = pieces.withColumn("g", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)).cast("int"))

    def run(t: pa.Table) -> pa.Table:
        doc, piece, total = (t.column(c).to_numpy() for c in ("doc_id", "piece", "n_tokens"))
        size = np.minimum(capacity, total - (piece - 1) * capacity)
        order = np.lexsort((piece, doc, -size))
        to = best_fit(size[order], capacity, max_docs, cost, rule=rule)
        t = t.take(pa.array(order))
        name = pa.array([f"{t.column('g')[0].as_py()}-{k}" for k in to])
        return pa.table([name, t.column("doc_id"), t.column("piece"), t.column("n_pieces"), pa.array((piece[order].astype(np.int64) - 1) * capacity), pa.array(size[order])], ["container", "doc_id", "piece", "n_pieces", "first_token", "n_tokens"])

    # an explicit number of partitions, which isn't coalesced: a group is little data but much work
    return pieces.repartition(groups, "g").groupBy("g").applyInArrow(run, "container string, doc_id bigint, piece int, n_pieces int, first_token bigint, n_tokens bigint")
