"""Packing into optimal length buckets.

Dynamic programming over the global histogram of lengths places the bucket
boundaries that minimise padding; inside each bucket documents in a shuffled
order form batches of a token budget.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlespark.llm.mixing import WORD
from candlespark.llm.running import buckets_for, hex_bucket, with_running_total
from candlespark.llm.staging import staged

def boundaries(lengths: Sequence[int], counts: Sequence[int], buckets: int) -> list[int]:
    """Bucket lengths, ascending, that minimise the sum of (bucket length - length) over all documents.

    lengths ascend. For k buckets ending at length j the cost is
    l[j] * C[j] - S[j] + min over i < j of (cost[k - 1][i] + S[i] - l[j] * C[i]):
    lines in l[j] whose slopes fall with i, so that a queue of the lower hull
    gives each layer in one pass. Whole numbers, so the optimum is exact.
    """
    n = len(lengths)
    total, tokens = [0], [0]
    for length, count in zip(lengths, counts, strict=True):
        total.append(total[-1] + count)
        tokens.append(tokens[-1] + count * length)
    cost: list[int | None] = [0] + [None] * n
    chosen: list[list[int]] = []
    for _ in range(min(buckets, n)):
        hull: deque[tuple[int, int, int]] = deque()  # slope, height, i
        new: list[int | None] = [None] * (n + 1)
        choice = [0] * (n + 1)
        for j in range(1, n + 1):
            if cost[j - 1] is not None:
                line = (-total[j - 1], cost[j - 1] + tokens[j - 1], j - 1)
                while len(hull) > 1 and (hull[-1][1] - hull[-2][1]) * (hull[-2][0] - line[0]) >= (line[1] - hull[-2][1]) * (hull[-2][0] - hull[-1][0]):
                    hull.pop()
                hull.append(line)
            if not hull:
                continue
            x = lengths[j - 1]
            while len(hull) > 1 and hull[1][0] * x + hull[1][1] <= hull[0][0] * x + hull[0][1]:
                hull.popleft()
            new[j] = x * total[j] - tokens[j] + hull[0][0] * x + hull[0][1]
            choice[j] = hull[0][2]
        cost = new
        chosen.append(choice)
    ends, j = [], n
    for choice in reversed(chosen):
        ends.append(lengths[j - 1])
        j = choice[j]
    return ends[::-1]


def pack(docs: DataFrame, *, buckets: int = 16, batch_tokens: int = 65_536, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, bucket, bucket_tokens, batch, place, padding.

    Tokens are words here. Every document is padded to its bucket's length
    (bucket_tokens), and a batch of a bucket holds as many documents as keep
    the padded batch within ``batch_tokens``, one at least: a document longer
    than the budget is a batch of its own. Only a bucket's last batch may be
    short. The order inside a bucket is a hash of identifier and length, so
    reruns agree on what equal rows get together. Empty and null texts have no
    tokens and go to the shortest bucket. Rows equal in identifier and length
    take places next to each other, in either order. An empty table gives no
    rows. Other columns are ignored.

    Boundaries are optimal for the exact lengths, however long. The histogram
    comes to the driver: one row for each distinct length, of which a corpus of
    T tokens has fewer than the square root of 2 T.
    """
    spark = docs.sparkSession
    sized = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint").alias("n_tokens"))
    sized = staged(sized.withColumn("key", F.md5(F.concat_ws(":", F.lit("pack"), F.col("doc_id").cast("string"), F.col("n_tokens").cast("string")))), "pack-lengths")
    histogram = sized.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).orderBy("n_tokens").collect()
    ends = boundaries([r["n_tokens"] for r in histogram], [r["n"] for r in histogram], buckets)
    table = spark.createDataFrame([(i, e) for i, e in enumerate(ends)], "bucket int, bucket_tokens bigint")
    bucket = F.size(F.filter(F.array(*[F.lit(e).cast("bigint") for e in ends]), lambda e: e < F.col("n_tokens"))) if ends else F.lit(0)
    placed = sized.withColumn("bucket", bucket.cast("int")).withColumn("one", F.lit(1).cast("bigint"))
    n = sum(r["n"] for r in histogram)
    placed = placed.withColumn("part", hex_bucket(F.col("key"), buckets_for(n)))
    order = [F.col(c) for c in ("key", "doc_id", "n_tokens")]
    ranked = with_running_total(placed, "bucket", "part", order, "one", "nth").join(F.broadcast(table), "bucket")
    a_batch = F.greatest(F.lit(1), F.floor(F.lit(batch_tokens) / F.greatest("bucket_tokens", F.lit(1)))).cast("bigint")
    at = F.col("nth") - 1
    return ranked.select(
        "doc_id",
        "n_tokens",
        "bucket",
        "bucket_tokens",
        F.floor(at / a_batch).cast("bigint").alias("batch"),
        F.pmod(at, a_batch).cast("bigint").alias("place"),
        (F.col("bucket_tokens") - F.col("n_tokens")).alias("padding"),
    )
