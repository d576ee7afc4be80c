"""The registered queries of the message-log engine, each with equivalent DuckDB SQL where SQL can express it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomlog.operators import index, integrity, lookup
from loomlog.operators.ordering import ranked
from loomlog.plans import models
from loomlog.plans.query import MessageFilter, Query, batches, indexed_messages, query_messages, read_messages, visited
from loomlog.session import ensure_checkpoint_dir
from loomlog.sources import format as f
from loomlog.sources import tables

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: The days that the time filters ask for: the recordings' times are nanoseconds since 1970.
DAY = 86_400 * 10**9
START = 1_704_067_200 * 10**9
T1, T2 = START + 10 * DAY, START + 17 * DAY

_M = """
with m as (
  select cast(dense_rank() over (order by event_type) as integer) as channel_id, concat('/events/', event_type) as topic,
         event_id as sequence, epoch_ns(ts) as log_time, octet_length(encode(props)) as n, props, user_id, value
  from events)
"""
_C = f"""{_M}, c as (
  select *, cast(floor((sum(31 + n) over (order by sequence) - (31 + n)) / {models.CHUNK_TARGET}) as bigint) as chunk_id from m)
"""


def query(sql: str | None = None):
    def add(run):
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return add


def _log(spark: SparkSession, sf_dir: str, **options) -> str:
    """The events as recordings, written once."""
    return models.recorded(spark, sf_dir, "events", lambda: models.event_messages(spark, sf_dir), **({"chunkSize": 65_536} | options))


def _one(spark: SparkSession, sf_dir: str, **options) -> str:
    """The events as one recording in the order of their sequence."""
    return models.recorded(spark, sf_dir, "events_one", lambda: models.event_messages(spark, sf_dir), files=1, **({"chunkSize": 65_536} | options))


def _declared(spark: SparkSession, sf_dir: str) -> str:
    """The events as recordings whose even channels have schemas."""
    return models.recorded(spark, sf_dir, "events_schemas", lambda: models.with_schemas(models.event_messages(spark, sf_dir)), chunkSize=65_536)


def _without_channel(spark: SparkSession, sf_dir: str, **options) -> str:
    """Recordings that lack the declaration of channel 3, unless the summary repeats it."""
    path = models.recorded(spark, sf_dir, "events_flat", lambda: models.with_schemas(models.event_messages(spark, sf_dir)), useChunks="false", dataCrc="false", **options)
    return models.changed(path, "without-3", models.retyped({f.CHANNEL: 0x80}, 3))


def _refused(spark: SparkSession, run) -> DataFrame:
    """The kind of the error that run() ends with."""
    try:
        run()
        kind = None
    except NotImplementedError:
        kind = "NotSupported"
    except Exception as e:  # the job's exception has the worker's error in its text
        kind = next((k for k in ("UnknownChannel", "RecordTooLarge", "Binding", "BadIndex") if k in str(e)), type(e).__name__)
    return spark.createDataFrame([(kind,)], "error_kind string")


def _chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models.event_messages(spark, sf_dir).withColumn("n", F.octet_length("data").cast("long"))
    return index.logical_chunks(m, "sequence", "n", models.CHUNK_TARGET)


_PLAIN = ["sequence", "channel_id", "log_time"]


# -- scans and filters ------------------------------------------------------------------------------------------------------
@query(_M + "select sequence, channel_id, log_time, md5(props) as digest from m")
def scan_file_order(spark, sf_dir):
    return read_messages(spark, _log(spark, sf_dir)).select(*_PLAIN, F.md5("data").alias("digest"))


@query(_M + "select sequence, channel_id, log_time from m where topic = '/events/click'")
def filter_topic(spark, sf_dir):
    return read_messages(spark, _log(spark, sf_dir), MessageFilter(topic="/events/click")).select(*_PLAIN)


@query(_M + "select sequence, channel_id, log_time from m where topic in ('/events/click', '/events/error', '/missing')")
def filter_topics(spark, sf_dir):
    return read_messages(spark, _log(spark, sf_dir), MessageFilter(topics=["/events/click", "/events/error", "/missing"])).select(*_PLAIN)


@query(_M + "select sequence, channel_id, log_time from m where false")
def filter_topics_empty(spark, sf_dir):
    return read_messages(spark, _log(spark, sf_dir), MessageFilter(topics=[])).select(*_PLAIN)


@query(_M + f"select sequence, channel_id, log_time from m where log_time >= {T1} and log_time < {T2}")
def filter_time(spark, sf_dir):
    return read_messages(spark, _log(spark, sf_dir), MessageFilter(start_time=T1, end_time=T2)).select(*_PLAIN)


@query(_M + f"select sequence, channel_id, log_time from m where topic = '/events/view' and log_time >= {T1} and log_time < {T2}")
def filter_topic_time(spark, sf_dir):
    return read_messages(spark, _log(spark, sf_dir), MessageFilter(topic="/events/view", start_time=T1, end_time=T2)).select(*_PLAIN)


@query(_M + "select sequence, channel_id, log_time from m where false")
def filter_time_equal_bounds(spark, sf_dir):
    return read_messages(spark, _log(spark, sf_dir), MessageFilter(start_time=T1, end_time=T1)).select(*_PLAIN)


@query(_M + f"select sequence, channel_id, log_time from m where topic = '/events/view' and log_time >= {T1} and log_time < {T2}")
def indexed_query(spark, sf_dir):
    return indexed_messages(spark, _log(spark, sf_dir), Query(topic="/events/view", start_time=T1, end_time=T2)).select(*_PLAIN)


@query(_M + f"select sequence, channel_id, log_time from m where topic = '/events/error' and log_time < {T1}")
def pushed_filters(spark, sf_dir):
    """Filters of the plan itself, taken by the source."""
    log = tables.read_table(spark, _log(spark, sf_dir), pushdown="true")
    return log.where((F.col("topic") == "/events/error") & (F.col("log_time") < T1)).select(*_PLAIN)


# -- order ------------------------------------------------------------------------------------------------------------------
_HOUR = "log_time - log_time % 3600000000000"


@query(_M + f", h as (select sequence, {_HOUR} as hour from m) select sequence, hour, row_number() over (order by hour, sequence) as position from h")
def order_log_time_rank(spark, sf_dir):
    m = query_messages(spark, _log(spark, sf_dir), Query(order="log_time"))
    return ranked(m.select("sequence", F.expr(_HOUR).alias("hour")), F.col("hour"), F.col("sequence"))


@query(_M + f", h as (select sequence, {_HOUR} as hour from m) select sequence, hour, row_number() over (order by hour, sequence) as position from h")
def order_ties_by_file(spark, sf_dir):
    """Equal times stand in file order."""
    m = tables.read_table(spark, _one(spark, sf_dir), payload="false").select("sequence", F.expr(_HOUR).alias("hour"), "path", "record_ordinal")
    return ranked(m, F.col("hour"), F.col("path"), F.col("record_ordinal")).select("sequence", "hour", "position")


@query(_M + f", h as (select sequence, {_HOUR} as hour from m) select sequence, hour, row_number() over (order by hour desc, sequence desc) as position from h")
def order_reverse_rank(spark, sf_dir):
    m = query_messages(spark, _log(spark, sf_dir), Query(order="reverse_log_time"))
    return ranked(m.select("sequence", F.expr(_HOUR).alias("hour")), F.col("hour").desc(), F.col("sequence").desc())


@query(_M + "select sequence, log_time, row_number() over (order by sequence) as position from m")
def order_file_rank(spark, sf_dir):
    return ranked(read_messages(spark, _log(spark, sf_dir)).select("sequence", "log_time", "path", "record_ordinal"), F.col("path"), F.col("record_ordinal")).select("sequence", "log_time", "position")


@query(_M + "select sequence, log_time from m order by log_time desc, sequence limit 100")
def top_latest(spark, sf_dir):
    """A top-k report: the hundred latest messages."""
    return tables.read_table(spark, _log(spark, sf_dir), payload="false").select("sequence", "log_time").orderBy(F.desc("log_time"), "sequence").limit(100)


# -- declarations -------------------------------------------------------------------------------------------------------------
_D = _M + """, ch as (select distinct channel_id as id, topic, 'json' as message_encoding, cast(case when channel_id % 2 = 0 then channel_id else 0 end as integer) as schema_id from m),
sc as (select schema_id as id, concat('schema', schema_id) as name, 'jsonschema' as encoding from ch where schema_id > 0)
"""


@query(_D + "select m.sequence, ch.topic, ch.schema_id, sc.name as schema_name from m join ch on m.channel_id = ch.id left join sc on ch.schema_id = sc.id")
def resolve_channels(spark, sf_dir):
    path = _declared(spark, sf_dir)
    read = lambda table: tables.read_table(spark, path, table)
    return lookup.resolve(read("messages"), tables.first_declarations(read("channels")), tables.schemas(spark, path), ["path"]).select("sequence", "topic", "schema_id", "schema_name")


@query(_D + "select m.sequence, ch.topic, ch.schema_id, sc.name as schema_name from m left join (select * from ch where id <> 3) ch on m.channel_id = ch.id left join sc on ch.schema_id = sc.id")
def raw_messages_unknown(spark, sf_dir):
    """Messages of an undeclared channel kept."""
    path = _without_channel(spark, sf_dir, emitSummary="false")
    read = lambda table: tables.read_table(spark, path, table, unknownChannels="keep")
    return lookup.resolve_raw(read("messages"), read("channels"), read("schemas"), ["path"]).select("sequence", "topic", "schema_id", "schema_name")


@query(_D + "select channel_id, count(*) as messages from m where channel_id not in (select id from ch where id <> 3) group by channel_id")
def unknown_channel_refs(spark, sf_dir):
    path = _without_channel(spark, sf_dir, emitSummary="false")
    read = lambda table: tables.read_table(spark, path, table, unknownChannels="keep")
    bad = lookup.unknown_references(read("messages"), read("channels").select("path", F.col("id").alias("channel_id")), ["path", "channel_id"])
    return bad.groupBy("channel_id").agg(F.count("*").alias("messages"))


@query(_M + ", d as (select channel_id, min(sequence) + 40 as declared_at from m group by channel_id) select m.sequence, m.channel_id from m join d using (channel_id) where declared_at > sequence")
def declared_before_use(spark, sf_dir):
    """Messages before their channel's declaration, which stands 40 places behind its first message."""

    def rows():
        m = models.event_messages(spark, sf_dir)
        return models.with_late_declarations(m, [tuple(r) for r in m.select("channel_id", "topic").distinct().collect()], 40)

    path = models.recorded(spark, sf_dir, "events_late", rows, files=1, order=("sequence", "kind"), useChunks="false", dataCrc="false", emitSummary="false")
    path = models.changed(path, "late", models.retyped({f.CHANNEL: 0x80, models.LATE: f.CHANNEL}))
    read = lambda table: tables.read_table(spark, path, table, unknownChannels="keep")
    return lookup.used_before_declared(read("messages"), read("channels").withColumnRenamed("id", "channel_id"), ["path", "channel_id"]).select("sequence", "channel_id")


@query(_M + "select channel_id as id, topic, min(sequence) as first_sequence from m group by channel_id, topic")
def first_declaration_per_id(spark, sf_dir):
    """The first declaration of each id, with the first message behind it."""
    path = _one(spark, sf_dir)
    first = tables.first_declarations(tables.read_table(spark, path, "channels")).select("path", "id", "topic", F.col("record_ordinal").alias("declared_at"))
    used = tables.read_table(spark, path).select("path", F.col("channel_id").alias("id"), "sequence", "record_ordinal")
    return used.join(first, ["path", "id"]).where("record_ordinal > declared_at").groupBy("id", "topic").agg(F.min("sequence").alias("first_sequence"))


@query("select cast(o_custkey % 50 as integer) as id, count(distinct o_orderstatus) as contents from orders group by 1 having count(distinct o_orderstatus) > 1")
def conflicting_ids(spark, sf_dir):
    """Ids that recordings declare differently, where ids are taken as common to all of them."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    found = None
    for status in [r[0] for r in orders.select("o_orderstatus").distinct().collect()]:
        rows = lambda: orders.where(F.col("o_orderstatus") == status).select(F.lit("channel").alias("kind"), (F.col("o_custkey") % 50).cast("int").alias("channel_id"), F.col("o_orderstatus").alias("topic"))  # noqa: B023, E731
        own = tables.read_table(spark, models.recorded(spark, sf_dir, f"orders_{status}", rows), "channels")
        found = own if found is None else found.unionByName(own)
    return index.conflicting_ids(found, ["id"], ["topic", "message_encoding", "metadata"])


@query(_D + "select id, name, encoding, md5('{}') as digest from sc")
def read_schemas(spark, sf_dir):
    return tables.schemas(spark, _declared(spark, sf_dir)).select("id", "name", "encoding", F.md5("data").alias("digest")).distinct()


@query(_D + "select ch.id, ch.topic, sc.name as schema_name from ch left join sc on ch.schema_id = sc.id")
def summary_fallback(spark, sf_dir):
    """Channels whose summary repeats no schemas: those come from the data section."""
    path = models.recorded(spark, sf_dir, "events_schemas", lambda: models.with_schemas(models.event_messages(spark, sf_dir)), files=1, repeatSchemas="false")
    return tables.channels(spark, path).select("id", "topic", "schema_name")


@query(_M + "select distinct channel_id as id, topic, 0 as schema_id from m")
def read_channels(spark, sf_dir):
    """Declared channels of all recordings: ids are scoped by recording, here the same in each."""
    return tables.channels(spark, _log(spark, sf_dir)).select("id", "topic", "schema_id").distinct()


# -- aggregations and indexes ---------------------------------------------------------------------------------------------------
@query(_M + "select topic, count(*) as message_count, min(log_time) as message_start_time, max(log_time) as message_end_time from m group by topic")
def statistics(spark, sf_dir):
    return index.statistics(tables.read_table(spark, _log(spark, sf_dir), payload="false"), ["topic"])


@query(_M + "select count(*) as message_count, min(log_time) as message_start_time, max(log_time) as message_end_time from m")
def summary_statistics(spark, sf_dir):
    """From the statistics records alone; no message is read."""
    s = tables.read_table(spark, _log(spark, sf_dir), "statistics")
    return s.agg(F.sum("message_count").alias("message_count"), F.min("message_start_time").alias("message_start_time"), F.max("message_end_time").alias("message_end_time"))


@query(_M + "select channel_id, count(*) as message_count from m group by channel_id")
def channel_counts(spark, sf_dir):
    s = tables.read_table(spark, _log(spark, sf_dir), "statistics").select(F.explode("channel_message_counts").alias("channel_id", "c"))
    return s.groupBy("channel_id").agg(F.sum("c").alias("message_count"))


@query(_M + "select 0 as differing, count(*) as messages, min(log_time) as first_time, max(log_time) as last_time from m")
def stored_chunk_index(spark, sf_dir):
    """The chunk indexes that recordings hold against those that follow from their messages."""
    path = _log(spark, sf_dir)
    m = tables.read_table(spark, path, payload="false").withColumn("chunk_start_offset", F.expr("shiftright(record_ordinal, 24)"))
    own = m.groupBy("path", "chunk_start_offset").agg(F.count("*").alias("n"), F.min("log_time").alias("a"), F.max("log_time").alias("b"))
    both = tables.read_table(spark, path, "chunk_index").join(own, ["path", "chunk_start_offset"], "full")
    same = F.coalesce((F.col("a") == F.col("start_time")) & (F.col("b") == F.col("end_time")), F.lit(False))
    return both.agg(F.sum(F.when(same, 0).otherwise(1)).cast("int").alias("differing"), F.sum("n").alias("messages"), F.min("start_time").alias("first_time"), F.max("end_time").alias("last_time"))


@query(_M + "select sequence, channel_id, log_time from m")
def seek_all_entries(spark, sf_dir):
    """Every entry of the stored message indexes, sought in its chunk."""
    entries = tables.read_table(spark, _log(spark, sf_dir), "message_index").where("offset is not null")
    return lookup.seek_messages(entries).select(*_PLAIN)


@query(_M + "select cast(sum(n) as bigint) as bytes, count(*) as messages from m")
def chunks_by_index(spark, sf_dir):
    """Chunks by their indexes, expanded to messages."""
    records = tables.expanded(lookup.chunks_of(spark, _log(spark, sf_dir))).where(F.col("opcode") == f.MESSAGE)
    return records.agg(F.sum(F.octet_length("body") - 22).alias("bytes"), F.count("*").alias("messages"))


@query(_M + f"select sequence, channel_id, log_time from m where log_time >= {T1} and log_time < {T2}")
def chunk_prune(spark, sf_dir):
    """Chunks that a time range needs, read by their places, then filtered."""
    path = _one(spark, sf_dir)
    starts = [r[0] for r in lookup.prune_chunks(tables.read_table(spark, path, "chunk_index"), T1, T2).select("chunk_start_offset").collect()]
    return MessageFilter(start_time=T1, end_time=T2).apply(tables.read_table(spark, path, access="indexed", chunkStarts=starts)).select(*_PLAIN)


@query(_C + "select chunk_id, min(log_time) as start_time, max(log_time) as end_time, count(*) as message_count, cast(sum(31 + n) as bigint) as uncompressed_size from c group by chunk_id")
def chunk_index(spark, sf_dir):
    return index.chunk_index(_chunked(spark, sf_dir), "chunk_id", "n")


@query(_C + 'select chunk_id, channel_id, log_time, cast(coalesce(sum(31 + n) over (partition by chunk_id order by sequence rows between unbounded preceding and 1 preceding), 0) as bigint) as "offset" from c')
def message_index(spark, sf_dir):
    return index.message_index(_chunked(spark, sf_dir), "chunk_id", "sequence", "n")


@query(_M + "select channel_id, count(*) as entries, min(log_time) as first_time, max(log_time) as last_time from m group by channel_id")
def stored_message_index(spark, sf_dir):
    """The message indexes that the recordings hold, entry by entry."""
    i = tables.read_table(spark, _log(spark, sf_dir), "message_index").where("log_time is not null")
    return i.groupBy("channel_id").agg(F.count("*").alias("entries"), F.min("log_time").alias("first_time"), F.max("log_time").alias("last_time"))


@query("select cast(doc_id as varchar) as name, 'text/plain' as media_type, doc_id as log_time, cast(octet_length(encode(coalesce(text, ''))) as bigint) as data_size from documents")
def attachments_index(spark, sf_dir):
    path = models.recorded(spark, sf_dir, "documents", lambda: models.document_attachments(spark, sf_dir))
    return tables.read_table(spark, path, "attachment_index").select("name", "media_type", "log_time", "data_size")


@query("select cast(doc_id as varchar) as name, md5(coalesce(text, '')) as digest from documents")
def read_attachments(spark, sf_dir):
    path = models.recorded(spark, sf_dir, "documents", lambda: models.document_attachments(spark, sf_dir))
    return tables.read_table(spark, path, "attachments").select("name", F.md5("data").alias("digest"))


@query("select concat('nation/', n_nationkey) as name, n_name as nation, cast(n_regionkey as varchar) as region from nation")
def metadata_index(spark, sf_dir):
    path = models.recorded(spark, sf_dir, "nation", lambda: models.nation_metadata(spark, sf_dir))
    return tables.read_table(spark, path, "metadata").select("name", F.col("values")["name"].alias("nation"), F.col("values")["region"].alias("region"))


@query(_M + "select sequence, channel_id, log_time, md5(props) as digest from m")
def mapped_scan(spark, sf_dir):
    """Recordings mapped into memory."""
    return read_messages(spark, _log(spark, sf_dir), mapped="true").select(*_PLAIN, F.md5("data").alias("digest"))


# -- seeks and forwarding -------------------------------------------------------------------------------------------------------
_REQUESTS = [5, 900, 5, 17, 333, 17]


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of a recording's message indexes by their number in file order, which is the sequence."""
    entries = tables.read_table(spark, _one(spark, sf_dir), "message_index").where("offset is not null")
    return ranked(entries, F.col("chunk_start_offset"), F.col("offset")).withColumn("entry", F.col("position") - 1)


@query(_M + "select sequence, channel_id, log_time from m where sequence = 5")
def seek_one(spark, sf_dir):
    return lookup.seek_messages(_places(spark, sf_dir).where("entry = 5")).select(*_PLAIN)


@query(_M + f"select req_no, sequence, channel_id, log_time from (values {', '.join(f'({i}, {s})' for i, s in enumerate(_REQUESTS))}) r(req_no, sequence) join m using (sequence)")
def seek_batch(spark, sf_dir):
    """Requests with duplicates, in their order; each chunk is loaded once."""
    requests = spark.createDataFrame(list(enumerate(_REQUESTS)), "req_no int, entry long").join(_places(spark, sf_dir), "entry")
    return lookup.grouped_seek(requests).select(F.col("req_no").cast("int"), *_PLAIN)


@query(_M + "select sequence, channel_id, log_time, true as as_often_as_chunks from m")
def seek_in_place(spark, sf_dir):
    """Every entry sought in file order without a shuffle: chunks are kept between requests, and each is loaded once."""
    entries = tables.read_table(spark, _log(spark, sf_dir), "message_index").where("offset is not null")
    found = lookup.seek_in_place(entries)
    loads = found.groupBy("path", "chunk_start_offset").agg((F.count_if("loaded") == 1).alias("as_often_as_chunks"))
    return found.join(loads, ["path", "chunk_start_offset"]).select(*_PLAIN, "as_often_as_chunks")


@query("select cast(doc_id as varchar) as name, md5(coalesce(text, '')) as digest from documents")
def read_indexed_attachments(spark, sf_dir):
    """Attachments by the offsets of their index."""
    path = models.recorded(spark, sf_dir, "documents", lambda: models.document_attachments(spark, sf_dir))
    return lookup.read_indexed(tables.read_table(spark, path, "attachment_index"), "attachments").select("name", F.md5("data").alias("digest"))


@query(f"select {f.METADATA} as opcode, count(*) as records from nation")
def records_at_offsets(spark, sf_dir):
    path = models.recorded(spark, sf_dir, "nation_one", lambda: models.nation_metadata(spark, sf_dir).coalesce(1))
    offsets = [r[0] for r in tables.read_table(spark, path, "metadata_index").select("offset").collect()]  # of one recording
    return tables.read_table(spark, path, "records", offsets=offsets).groupBy("opcode").agg(F.count("*").alias("records"))


@query(f"select group_opcode, true as ok from (values ({f.SCHEMA}), ({f.CHANNEL}), ({f.STATISTICS}), ({f.CHUNK_INDEX})) v(group_opcode)")
def footer_and_offsets(spark, sf_dir):
    """The groups of the summary, each behind where the footer says that it begins and before its end."""
    path = models.recorded(spark, sf_dir, "events_schemas", lambda: models.with_schemas(models.event_messages(spark, sf_dir)), files=1)
    groups = tables.read_table(spark, path, "summary_offsets").join(tables.read_table(spark, path, "footer").select("path", "summary_start", "summary_offset_start"), "path")
    return groups.select("group_opcode", F.expr("group_start >= summary_start and group_start + group_length <= summary_offset_start").alias("ok"))


@query(_M + "select sequence, channel_id, log_time, md5(props) as digest from m")
def prefixed_origin(spark, sf_dir):
    """Recordings that begin behind 17 other bytes."""
    path = models.changed(_log(spark, sf_dir), "prefixed", models.prefixed(b"j" * 17))
    return tables.read_table(spark, path, startOffset=17).select(*_PLAIN, F.md5("data").alias("digest"))


@query(_M + f"select {f.MESSAGE} as opcode, count(*) as records from m union all select {f.CHANNEL}, count(distinct channel_id) from m")
def records_by_opcode(spark, sf_dir):
    """The expanded records of the data section, by kind."""
    records = tables.read_table(spark, _one(spark, sf_dir), "records").where(F.col("opcode").isin(f.MESSAGE, f.CHANNEL) & ~F.col("in_summary"))
    return records.groupBy("opcode").agg(F.count("*").alias("records"))


@query(_M + ", e as (select min(sequence) as last from m where topic = '/events/error' and log_time >= " + str(T1) + ") select sequence, channel_id, log_time from m, e where sequence <= last")
def visit_until(spark, sf_dir):
    """Messages up to and with the first error of a day, as a visitor that stops there sees them."""
    return visited(tables.read_table(spark, _one(spark, sf_dir)), f"topic = '/events/error' and log_time >= {T1}").select(*_PLAIN)


@query("select 'UnknownChannel' as error_kind")
def unknown_channel_is_an_error(spark, sf_dir):
    """Even where the filter asks for other topics, and though the summary declares the channel."""
    path = _without_channel(spark, sf_dir)
    return _refused(spark, lambda: read_messages(spark, path, MessageFilter(topic="/events/click")).count())


@query("select 'RecordTooLarge' as error_kind")
def record_limit(spark, sf_dir):
    return _refused(spark, lambda: tables.read_table(spark, _log(spark, sf_dir), recordLengthLimit=20).count())


@query("select 'NotSupported' as error_kind")
def sort_not_allowed(spark, sf_dir):
    """Without a usable index the order needs a sort."""
    return _refused(spark, lambda: query_messages(spark, _without_channel(spark, sf_dir, emitSummary="false"), Query(allow_sort=False)))


@query("select 'Binding' as error_kind")
def sort_beyond_allowance(spark, sf_dir):
    path = models.recorded(spark, sf_dir, "events_flat", lambda: models.event_messages(spark, sf_dir), useChunks="false")
    return _refused(spark, lambda: query_messages(spark, path, Query(max_sort_bytes=100)))


@query(_M + "select sequence, channel_id + 100 as channel_id, log_time from m")
def forward_remap(spark, sf_dir):
    m = read_messages(spark, _log(spark, sf_dir))
    ids = spark.range(1, 65_436).select(F.col("id").cast("int").alias("channel_id"), (F.col("id") + 100).cast("int").alias("new_id"))
    return lookup.forward(m, ids).select(*_PLAIN)


@query(_M + "select sequence, channel_id + 100 as channel_id, concat('/copy', topic) as topic, md5(props) as digest from m where topic = '/events/view'")
def forward_to_recordings(spark, sf_dir):
    """Messages of one topic forwarded to other recordings, under another id and topic."""

    def rows():
        m = tables.read_table(spark, _log(spark, sf_dir), topic="/events/view")
        ids = m.select("channel_id").distinct().withColumn("new_id", F.col("channel_id") + 100)
        return lookup.forward(m, ids).withColumn("topic", F.concat(F.lit("/copy"), "topic")).drop("schema_id")

    return tables.read_table(spark, models.recorded(spark, sf_dir, "forwarded", rows)).select("sequence", "channel_id", "topic", F.md5("data").alias("digest"))


# -- the sink's other records ---------------------------------------------------------------------------------------------------
@query(_M + "select md5(props) as digest, sequence % 2 = 0 as chunked from m where topic = '/events/error'")
def private_records(spark, sf_dir):
    """Private records alone, half of them inside chunks."""

    def rows():
        m = models.event_messages(spark, sf_dir).where("topic = '/events/error'")
        return m.select(F.lit("private").alias("kind"), F.lit(200).alias("opcode"), (F.col("sequence") % 2 == 0).alias("in_chunks"), "sequence", "data")

    found = tables.read_table(spark, models.recorded(spark, sf_dir, "private", rows), "records").where("opcode = 200")
    return found.select(F.md5("body").alias("digest"), (F.col("chunk_ordinal") >= 0).alias("chunked"))


@query("select cast(doc_id as varchar) as name, md5(coalesce(text, '')) as digest from documents")
def segmented_attachments(spark, sf_dir):
    """Attachments written in parts: a length, two halves, an end."""

    def rows():
        d = models.document_attachments(spark, sf_dir).withColumn("n", F.octet_length("data").cast("long"))
        part = lambda kind, data, length=None: F.struct(F.lit(kind).alias("kind"), data.alias("data"), (F.lit(None) if length is None else length).cast("long").alias("length"))
        none, half = F.lit(None).cast("binary"), F.expr("n div 2")
        parts = F.array(part("attachment_start", none, F.col("n")), part("attachment_part", F.expr("substring(data, 1, cast(n div 2 as int))")), part("attachment_part", F.expr("substring(data, cast(n div 2 as int) + 1)")), part("attachment_finish", none))
        return d.withColumn("half", half).select("name", "media_type", "log_time", "create_time", F.explode(parts).alias("p")).select("name", "media_type", "log_time", "create_time", "p.*")

    path = models.recorded(spark, sf_dir, "segmented", rows)
    return tables.read_table(spark, path, "attachments").select("name", F.md5("data").alias("digest"))


def _quarantined(spark: SparkSession, sf_dir: str) -> str:
    rows = lambda: models.event_messages(spark, sf_dir).withColumn("log_time", F.when(F.col("topic") != "/events/click", F.col("log_time")))
    return models.recorded(spark, sf_dir, "quarantine", rows, badRows="QUARANTINE")


@query(_M + "select 'a message needs a log_time' as reason, sequence, hex(encode(props)) as data from m where topic = '/events/click'")
def quarantined_rows(spark, sf_dir):
    """Rows that the sink put aside, with the reason."""
    bad = tables.rejected(spark, _quarantined(spark, sf_dir))
    return bad.select("reason", F.get_json_object("row", "$.sequence").cast("long").alias("sequence"), F.upper(F.get_json_object("row", "$.data")).alias("data"))


@query(_M + "select count(*) as rows, count(*) filter (topic = '/events/click') as rejected, count(*) filter (topic <> '/events/click') as messages from m")
def written_report(spark, sf_dir):
    """What the sink reports of its jobs."""
    w = tables.written(spark, _quarantined(spark, sf_dir))
    return w.agg(F.sum("rows").alias("rows"), F.sum("rejected").alias("rejected"), F.sum("statistics.message_count").alias("messages"))


@query(_M + "select sequence, cast(floor((row_number() over (order by sequence) - 1) / 256) as bigint) as batch from m")
def batch_by_count(spark, sf_dir):
    path = models.recorded(spark, sf_dir, "events_one", lambda: models.event_messages(spark, sf_dir), files=1)
    log = tables.read_table(spark, path)
    return batches(log, 256, 1 << 40).join(log.select("path", "record_ordinal", "sequence"), ["path", "record_ordinal"]).select("sequence", "batch")


@query(
    _M.replace("with m", "with recursive m")
    + """, s as materialized (select row_number() over (order by sequence) as i, sequence, n, sum(n) over (order by sequence) as upto from m),
g as materialized (select a.i as first, least(a.i + 256, coalesce(b.i, a.i + 255) + 1) as next from s a asof left join s b on a.upto - a.n + 1000 <= b.upto),
b as (select cast(0 as bigint) as batch, first, next from g where first = 1 union all select batch + 1, g.first, g.next from b join g on g.first = b.next)
select sequence, batch, cast(n as bigint) as size from s asof join b on s.i >= b.first"""
)
def batch_soft_target(spark, sf_dir):
    """A batch ends with the message that reaches 1000 bytes, or after 256."""
    path = models.recorded(spark, sf_dir, "events_one", lambda: models.event_messages(spark, sf_dir), files=1)
    log = tables.read_table(spark, path)
    return batches(log, 256, 1000).join(log.select("path", "record_ordinal", "sequence"), ["path", "record_ordinal"]).select("sequence", "batch", "size")


# -- integrity ------------------------------------------------------------------------------------------------------------------
@query(_M + "select sequence, channel_id, log_time from m where sequence < (select max(sequence) from m)")
def recover_prefix(spark, sf_dir):
    """A recording cut in its last message gives all messages before it."""
    return integrity.recover(spark, _cut(spark, sf_dir))[0].select(*_PLAIN)


def _cut(spark: SparkSession, sf_dir: str) -> str:
    path = models.recorded(spark, sf_dir, "events_flat", lambda: models.event_messages(spark, sf_dir), files=1, useChunks="false")
    return models.changed(path, "cut", models.cut_in_last_message)


@query(_M + "select false as fully_validated, count(*) - 1 as recovered_messages, 'UnexpectedEof' as error_kind from m")
def recovery_report(spark, sf_dir):
    return integrity.recover(spark, _cut(spark, sf_dir))[1].select("fully_validated", "recovered_messages", "error_kind")


@query("select 'UnknownChannel' as error_kind, 'StrictFullScan' as validation_scope")
def validate_references(spark, sf_dir):
    """Declarations of the summary don't satisfy the data section."""
    return integrity.validation_report(spark, _without_channel(spark, sf_dir)).where("not ok").select("error_kind", "validation_scope").distinct()


@query(_M + "select true as ok, count(*) as messages from m")
def validate_report(spark, sf_dir):
    r = integrity.validation_report(spark, _log(spark, sf_dir))
    return r.agg(F.min("ok").alias("ok"), F.sum("messages").alias("messages"))


@query(_M + "select 'chunk' as kind, true as ok, count(*) as messages from m union all select 'attachment', true, 0")
def crc_checks(spark, sf_dir):
    """Computed checksums of chunks and attachments against the stored ones."""
    path = models.recorded(spark, sf_dir, "documents", lambda: models.document_attachments(spark, sf_dir))
    sums = integrity.crc_report(spark, _log(spark, sf_dir)).unionByName(integrity.crc_report(spark, path))
    return sums.groupBy("kind").agg(F.min("ok").alias("ok"), F.sum("messages").alias("messages"))


def _round_trip(codec: str):
    def run(spark, sf_dir):
        return read_messages(spark, _log(spark, sf_dir, compression=codec), strict="true").select("sequence", "topic", "log_time", F.md5("data").alias("digest"))

    run.__name__ = f"codec_roundtrip_{codec}"
    return query(_M + "select sequence, topic, log_time, md5(props) as digest from m")(run)


for _codec in ("none", "lz4", "zstd"):
    _round_trip(_codec)


@query(_M + "select sequence, channel_id, log_time, md5(props) as digest from m")
def read_binary_files(spark, sf_dir):
    """The same recordings through Spark's own file reader, as for stores that only Spark opens."""
    return tables.read_binary(spark, _log(spark, sf_dir)).select(*_PLAIN, F.md5("data").alias("digest"))


@query(_M + "select sequence, channel_id, log_time, md5(props) as digest from m")
def expand_chunks(spark, sf_dir):
    """Chunks as rows, expanded to records, messages parsed by columns."""
    from loomlog.functions.records import payload

    records = tables.expanded(tables.read_table(spark, _log(spark, sf_dir), "chunks")).where("opcode = 5")
    number = lambda a, n: F.conv(F.concat(*[F.hex(F.substring("body", a + n - 1 - k, 1)) for k in range(n)]), 16, 10)
    return records.select(number(3, 4).cast("long").alias("sequence"), number(1, 2).cast("int").alias("channel_id"), number(7, 8).cast("long").alias("log_time"), F.md5(payload(F.col("body"))).alias("digest"))


@query()
def parsed_records(spark, sf_dir):
    """Every record of the recordings as JSON."""
    from loomlog.functions.records import parse_record

    tables.register(spark)
    return tables.read_table(spark, _log(spark, sf_dir), "records").select("opcode", parse_record("opcode", "body").alias("record"))


@query(_M + "select sequence, channel_id, log_time, hex(encode(props)) as data from m")
def parsed_messages(spark, sf_dir):
    """The messages among them, from the JSON."""
    m = parsed_records(spark, sf_dir).where(F.col("opcode") == f.MESSAGE)
    get = lambda name, kind: F.get_json_object("record", f"$.{name}").cast(kind).alias(name)
    return m.select(get("sequence", "long"), get("channel_id", "int"), get("log_time", "long"), F.upper(F.get_json_object("record", "$.data")).alias("data"))


@query(_M + """select 'channels' as "group", count(distinct channel_id) as records, count(distinct channel_id) as named from m
union all select 'schemas', count(distinct channel_id) filter (channel_id % 2 = 0), count(distinct channel_id) filter (channel_id % 2 = 0) from m
union all select 'statistics', 1, 0 union all select 'chunk_index', 1, 0""")
def summary_records(spark, sf_dir):
    """The records of a summary by group; channels and schemas have names."""
    path = models.recorded(spark, sf_dir, "events_schemas", lambda: models.with_schemas(models.event_messages(spark, sf_dir)), files=1, chunkSize=1 << 40)
    named = F.coalesce(F.get_json_object("record", "$.topic"), F.get_json_object("record", "$.name"))
    return tables.summary_records(spark, path).groupBy("group").agg(F.count("*").alias("records"), F.count(named).alias("named"))


# -- streaming --------------------------------------------------------------------------------------------------------------------
def _drained(spark: SparkSession, stream: DataFrame, mode: str = "append", folder: str | None = None) -> DataFrame:
    """What a stream gives until its input is used up, as a table in the shared folder, with what it gave there before."""
    folder = folder or f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"

    def put(rows: DataFrame, batch: int) -> None:
        # A batch that is repeated writes its own folder again; in complete mode the last batch is the whole result.
        rows.write.mode("overwrite").parquet(f"{folder}/out" if mode == "complete" else f"{folder}/out/batch={batch}")

    q = stream.writeStream.foreachBatch(put).outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out").select(*stream.columns)


@query(_M + "select sequence, channel_id, log_time, md5(props) as digest from m")
def stream_scan(spark, sf_dir):
    from loomlog.streaming.streams import read_stream

    return _drained(spark, read_stream(spark, _log(spark, sf_dir)).select(*_PLAIN, F.md5("data").alias("digest")))


@query(_M + "select sequence, channel_id, log_time from m where sequence < (select max(sequence) from m)")
def stream_recover(spark, sf_dir):
    """The valid prefix of an unfinished recording, as a stream."""
    from loomlog.streaming.streams import read_stream

    return _drained(spark, read_stream(spark, _cut(spark, sf_dir), mode="recover").select(*_PLAIN))


@query(_M + "select sequence, channel_id, log_time, md5(props) as digest from m")
def stream_follow(spark, sf_dir):
    """Recordings followed while they grow: each poll finds some more bytes, records cut anywhere."""
    from loomlog.streaming.streams import read_stream

    folder = f"{ensure_checkpoint_dir(spark)}/follow-{uuid.uuid4().hex}"
    out = None
    for part in models.growing(_log(spark, sf_dir), f"{folder.removeprefix('file:')}/in", 3):
        out = _drained(spark, read_stream(spark, part, follow="true").select(*_PLAIN, F.md5("data").alias("digest")), folder=folder)
    return out


@query(_M + "select sequence, channel_id, log_time, md5(props) as digest from m")
def stream_sink(spark, sf_dir):
    """A stream of recordings written as recordings."""
    from loomlog.streaming.streams import read_stream, write_stream

    folder = f"{ensure_checkpoint_dir(spark).removeprefix('file:')}/sink-{uuid.uuid4().hex}"
    write_stream(read_stream(spark, _log(spark, sf_dir)), f"{folder}/out", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return tables.read_table(spark, f"{folder}/out").select(*_PLAIN, F.md5("data").alias("digest"))


@query(_M + "select topic, log_time - log_time % 86400000000000 as day, count(*) as messages from m group by all")
def stream_windows(spark, sf_dir):
    """Tumbling days of a stream."""
    from loomlog.streaming.streams import read_stream, windowed_counts

    counts = windowed_counts(read_stream(spark, _log(spark, sf_dir)), "1 day", "2 days")
    return _drained(spark, counts.select("topic", (F.unix_micros("start") * 1000).alias("day"), "messages"), "complete")


# -- Spark's own operators over the message table ----------------------------------------------------------------------------------
@query(
    _M
    + """, l as (select sequence, user_id, log_time from m where topic = '/events/purchase'),
r as (select user_id, log_time, value from m where topic = '/events/view')
select l.sequence, r.value from l asof left join r on l.user_id = r.user_id and l.log_time >= r.log_time"""
)
def asof_lookup(spark, sf_dir):
    """The last viewed value at each purchase of a user."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("log_time", models.nanoseconds("ts"))
    left = e.where("event_type = 'purchase'").select("user_id", "log_time", F.col("event_id").alias("sequence"))
    right = e.where("event_type = 'view'").select("user_id", "log_time", "value")
    return lookup.as_of(left, right, ["user_id"], "log_time", "value").select("sequence", "value")


@query(_M + ", s as (select sequence as span, log_time as t0, log_time + 600000000000 as t1 from m where topic = '/events/error') select span, count(*) as messages from s join m on m.log_time >= t0 and m.log_time < t1 group by span")
def interval_counts(spark, sf_dir):
    """Messages in the ten minutes from each error."""
    m = tables.read_table(spark, _log(spark, sf_dir), payload="false")
    spans = m.where("topic = '/events/error'").select(F.col("sequence").alias("span"), F.col("log_time").alias("t0"), (F.col("log_time") + 600 * 10**9).alias("t1"))
    return lookup.interval_join(m.select("log_time"), spans, "log_time", "t0", "t1", 600 * 10**9).groupBy("span").agg(F.count("*").alias("messages"))


@query(_M + "select topic, (log_time - log_time % 3600000000000) as hour, count(*) as messages, cast(sum(n) as bigint) as bytes from m group by all")
def tumbling_counts(spark, sf_dir):
    m = tables.read_table(spark, _log(spark, sf_dir))
    return m.groupBy("topic", F.expr(_HOUR).alias("hour")).agg(F.count("*").alias("messages"), F.sum(F.octet_length("data")).cast("long").alias("bytes"))


@query(
    _M
    + """, g as (select user_id, log_time, case when log_time - lag(log_time) over (partition by user_id order by log_time, sequence) <= 3600000000000 then 0 else 1 end as fresh, sequence from m),
s as (select *, sum(fresh) over (partition by user_id order by log_time, sequence) as session from g)
select user_id, session, count(*) as messages, min(log_time) as first_time, max(log_time) as last_time from (select user_id, cast(session as bigint) as session, log_time from s) group by user_id, session"""
)
def session_counts(spark, sf_dir):
    """Sessions of users: a gap of more than an hour starts a new one."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "event_id", models.nanoseconds("ts").alias("log_time"))
    w = Window.partitionBy("user_id").orderBy("log_time", "event_id")
    gap = F.when(F.col("log_time") - F.lag("log_time").over(w) <= 3600 * 10**9, 0).otherwise(1)
    s = e.withColumn("fresh", gap).withColumn("session", F.sum("fresh").over(w))
    return s.groupBy("user_id", "session").agg(F.count("*").alias("messages"), F.min("log_time").alias("first_time"), F.max("log_time").alias("last_time"))


@query(_M + "select coalesce(topic, 'all') as topic, count(*) as messages, count(distinct user_id) as users from m group by rollup (topic)")
def rollup_counts(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.concat(F.lit("/events/"), "event_type").alias("topic"), "user_id")
    return e.rollup("topic").agg(F.count("*").alias("messages"), F.count_distinct("user_id").alias("users")).withColumn("topic", F.coalesce("topic", F.lit("all")))


@query(_M + "select topic, cast(json_extract(props, '$.k') as bigint) as k, count(*) as messages from m group by all")
def payload_json(spark, sf_dir):
    """Payloads decoded by Spark: the container itself treats them as bytes."""
    m = tables.read_table(spark, _log(spark, sf_dir))
    return m.select("topic", F.from_json(F.decode("data", "UTF-8"), "k long").alias("p")).groupBy("topic", F.col("p.k").alias("k")).agg(F.count("*").alias("messages"))


@query("select concat('/conv/', role) as topic, turn as sequence, count(*) as messages, cast(sum(octet_length(encode(text))) as bigint) as bytes from conversations group by all")
def conversation_topics(spark, sf_dir):
    path = models.recorded(spark, sf_dir, "conversations", lambda: models.conversation_messages(spark, sf_dir))
    m = tables.read_table(spark, path)
    return m.groupBy("topic", "sequence").agg(F.count("*").alias("messages"), F.sum(F.octet_length("data")).cast("long").alias("bytes"))


@query("with l as (select concat('/flag/', l_returnflag) as topic, l_orderkey, l_extendedprice, l_shipdate from lineitem) select topic, count(*) as messages, cast(sum(l_orderkey) as bigint) as orders, min(epoch_ns(l_shipdate)) as first_time, max(epoch_ns(l_shipdate)) as last_time from l group by topic")
def lineitem_messages(spark, sf_dir):
    """Wide rows as messages: recorded with JSON payloads, read back and aggregated from the payloads."""
    m = tables.read_table(spark, _lineitem(spark, sf_dir))
    order = F.get_json_object(F.decode("data", "UTF-8"), "$.l_orderkey").cast("long")
    return m.groupBy("topic").agg(F.count("*").alias("messages"), F.sum(order).alias("orders"), F.min("log_time").alias("first_time"), F.max("log_time").alias("last_time"))


def _lineitem(spark: SparkSession, sf_dir: str) -> str:
    def rows():
        # A file of one row group would be one task and one recording.
        l = spark.read.parquet(f"{sf_dir}/lineitem.parquet").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "l_orderkey")
        ids = models.numbered(l, "l_returnflag", "channel_id")
        return l.join(F.broadcast(ids), "l_returnflag").select("channel_id", F.concat(F.lit("/flag/"), "l_returnflag").alias("topic"), F.lit("json").alias("message_encoding"), models.nanoseconds("l_shipdate").alias("log_time"), F.encode(F.to_json(F.struct("l_orderkey", "l_linenumber", "l_quantity")), "UTF-8").alias("data"))

    return models.recorded(spark, sf_dir, "lineitem", rows)


#: Recordings that queries share, for timing their writing apart.
WRITES = {
    "write_events": _log,
    "write_events_one": _one,
    "write_lineitem": _lineitem,
    "write_documents": lambda spark, sf_dir: models.recorded(spark, sf_dir, "documents", lambda: models.document_attachments(spark, sf_dir)),
}
