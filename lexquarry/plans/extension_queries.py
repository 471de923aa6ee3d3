"""Queries with functions of the user's own kinds, vectors, streams and files that go out and come back."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexquarry.functions import udfs
from lexquarry.operators.vectors import cosine_topk, nearest
from lexquarry.plans.registry import Tables, query
from lexquarry.scratch import new_path, save
from lexquarry.sources.records import write_csv
from lexquarry.streaming import events


@query("""
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), q AS (SELECT * FROM v WHERE vec_id % 50 = 0), s AS (SELECT q.vec_id AS query, v.vec_id AS key, round(list_cosine_similarity(q.e, v.e), 6) AS similarity FROM q JOIN v ON q.vec_id <> v.vec_id)
SELECT query, key, similarity, rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, key) AS rank FROM s) WHERE rank <= 10""")
def vector_topk(t: Tables) -> DataFrame:
    """The ten nearest vectors of every fiftieth one, exactly."""
    return cosine_topk(t.embeddings.where("vec_id % 50 = 0"), t.embeddings, "vec_id", "embedding", 10)


@query()
def vector_cells(t: Tables) -> DataFrame:
    """The ten nearest vectors of every fiftieth one by cells (approximate: recall is tested against the exact ones)."""
    return nearest(t.embeddings.where("vec_id % 50 = 0"), t.embeddings, "vec_id", "embedding", 10)


@query("SELECT user_id, median(value) AS middle, count(*)::BIGINT AS n FROM events GROUP BY user_id")
def grouped_function(t: Tables) -> DataFrame:
    """A grouped aggregate of the user's own."""
    return t.events.groupBy("user_id").agg(udfs.middle("value").alias("middle")).join(t.events.groupBy("user_id").agg(F.count("*").alias("n")), "user_id")


@query("SELECT conv_id, turn, (i - 1)::INT AS pos, w[i] AS word FROM (SELECT conv_id, turn, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT conv_id, turn, string_split(text, ' ') AS w FROM conversations))")
def table_function(t: Tables) -> DataFrame:
    """A table function of the user's own, joined laterally."""
    texts = t.conversations.select("conv_id", "turn", "text").alias("c")
    return texts.lateralJoin(udfs.Words(F.col("c.text").outer())).select("conv_id", "turn", "pos", "word")


@query()
def similarity_ratios(t: Tables) -> DataFrame:
    """Names of parts of one brand and size against each other's next, by matching blocks (tested against the library's own)."""
    from pyspark.sql import Window

    following = F.lead("p_name").over(Window.partitionBy("p_brand", "p_size").orderBy("p_partkey"))
    pairs = t.part.select("p_partkey", "p_name", following.alias("other")).where("other IS NOT NULL")
    return pairs.select("p_partkey", udfs.similarity_ratio("p_name", "other").alias("ratio"), udfs.name_uuid("p_name").alias("uid"))


@query("SELECT doc_id, length(text)::BIGINT AS n FROM documents")
def repaired_texts(t: Tables) -> DataFrame:
    """Texts that went through the wrong code page and back: as long as they were."""
    broken = t.documents.select("doc_id", udfs.decoded(F.encode("text", "UTF-8"), F.lit("latin-1")).alias("text"))
    return broken.select("doc_id", F.length(udfs.repaired("text")).cast("long").alias("n"))


# ---- streams ----------------------------------------------------------------


def _streamed(t: Tables, name: str, make) -> DataFrame:
    """What a stream over the events has put out when it has read all there is."""
    source = t.spark.readStream.schema(t.events.schema).parquet(f"{t.folder}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    folder = new_path(t.spark, f"stream-{name}")
    out = make(source)
    out.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/log").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.schema(out.schema).parquet(f"{folder}/out")


@query("""
WITH w AS (SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS d, count(*)::BIGINT AS n FROM events GROUP BY 1, 2), m AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM events)
SELECT event_type, strftime(d, '%Y-%m-%d') AS day, n FROM w, m WHERE d + INTERVAL 1 DAY <= mark""")
def watermark_counts(t: Tables) -> DataFrame:
    """Daily counts of a stream; a day goes out when the watermark, an hour behind the latest event, has passed it."""

    def make(source: DataFrame) -> DataFrame:
        counts = source.withWatermark("ts", "1 hour").groupBy("event_type", F.window("ts", "1 day")).agg(F.count("*").alias("n"))
        return counts.select("event_type", F.date_format("window.start", "yyyy-MM-dd").alias("day"), "n")

    return _streamed(t, "days", make)


@query("SELECT event_id, user_id, event_type FROM events")
def stream_distinct(t: Tables) -> DataFrame:
    """A stream that brings every event twice, without the repeats inside the watermark."""
    twice = lambda source: events.distinct_events(source.unionByName(source), "event_id", late="1 hour").select("event_id", "user_id", "event_type")
    return _streamed(t, "distinct", twice)


# ---- files ------------------------------------------------------------------


@query("""
WITH l AS (SELECT l_orderkey, list(l_partkey ORDER BY l_partkey) AS parts FROM lineitem GROUP BY 1) SELECT l_orderkey, len(parts)::BIGINT AS n, '[' || array_to_string(parts, ',') || ']' AS parts FROM l""")
def csv_roundtrip(t: Tables) -> DataFrame:
    """Lists written to CSV as JSON and read again."""
    lists = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_partkey")).alias("parts"))  # the lines of one order
    path = new_path(t.spark, "csv")
    write_csv(lists, path)
    back = t.spark.read.option("header", True).option("escape", '"').schema("l_orderkey long, parts string").csv(path)
    return back.select("l_orderkey", F.size(F.from_json("parts", "array<long>")).cast("long").alias("n"), "parts")


@query("SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def saved_join(t: Tables) -> DataFrame:
    """A result cut from its lineage by a table in the shared folder."""
    return save(t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name"), "nations")
