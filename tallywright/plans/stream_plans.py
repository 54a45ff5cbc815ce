"""A finite stream over the events file, counted and written batch by batch."""

import uuid

from pyspark.sql import functions as F

from ..runtime import rows_of, shared_dir
from ..streaming import run
from .catalog import query, table


@query("stream_counts", "SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1")
def stream_counts(spark, d):
    schema = table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    place = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    # complete mode: the last batch holds all groups, so each batch replaces the one before
    run.run_stream(
        run.count_stream(stream, "event_type"),
        lambda df, _: df.write.mode("overwrite").parquet(f"{place}/out"),
        f"{place}/progress",
        output_mode="complete",
    )
    return spark.read.parquet(f"{place}/out")


COUNTERS = {"records": "true", "clicks": "event_type = 'click'", "large": "value > 50", "late": "ts >= '1998-01-01'"}


@query("stream_counters", """
SELECT 'records' AS counter, CAST(count(*) AS BIGINT) AS n FROM events UNION ALL SELECT 'clicks', count(*) FILTER (event_type = 'click') FROM events
UNION ALL SELECT 'large', count(*) FILTER (value > 50) FROM events UNION ALL SELECT 'late', count(*) FILTER (ts >= '1998-01-01') FROM events
UNION ALL SELECT 'written', count(*) FROM events
""")
def stream_counters(spark, d):
    """Counters kept while the stream is written, through a restart; ``written`` counts the rows of the sink itself."""
    schema = table(spark, d, "events").schema
    place = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    each = lambda df, batch: df.write.mode("overwrite").parquet(f"{place}/out/batch={batch}")
    for _ in range(2):  # the second run goes on where the first one stopped and finds nothing new
        stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
        run.run_stream(stream, run.counting_batches(COUNTERS, f"{place}/counts", each), f"{place}/progress")
    wide = run.counted_so_far(spark, f"{place}/counts", COUNTERS)
    long = rows_of(wide, "counter", "n", [(c, F.col(c)) for c in COUNTERS]).select("counter", "n")
    return long.unionByName(spark.read.parquet(f"{place}/out").agg(F.count(F.lit(1)).alias("n")).select(F.lit("written").alias("counter"), "n"))
