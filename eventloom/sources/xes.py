"""XES event logs as event tables.

A log is ``log > trace > event``; traces and events hold typed attributes with
a key and a value. The file is read as text that ends at each ``</trace>``, so
plain files are split into as many tasks as their size calls for (a gzip file is
one task up to there; what follows is dealt out again by ``spread``). A trace is one XML
element and is parsed as a whole.

Attributes within attributes are read :data:`DEPTH` level deep (each more makes the
parsed table six times as wide); a path of keys (``amount/currency``) names them. A list becomes a text, the JSON array of its values.
Defaults of ``<global>`` in the head of a file hold for its traces and events without
the attribute.

Nothing that cannot be read is dropped in silence: :func:`rejected_traces` has a row
for each trace that is cut short or no XML, and for each file without an end, and
:func:`rejected_cells` one for each value that is not of its type. ``read_log``
refuses a log of which more than a stated share is rejected.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.spec import LogSpec
from eventloom.staging import stage

# Attribute elements of the format and the column types they become
TYPES = {"string": "string", "date": "timestamp", "float": "double", "int": "bigint", "boolean": "boolean", "id": "string", "list": "string"}

TRACE_END, LOG_END = "</trace>", "</log>"
#: Levels of attributes within attributes
DEPTH = 1
#: Between the keys of a path
PATH = "/"
_SIMPLE = [t for t in TYPES if t != "list"]


def _attributes(depth: int) -> list[T.StructField]:
    """The fields of an element that holds attributes, with those within them."""
    inner = _attributes(depth - 1) if depth else []
    pairs = T.ArrayType(T.StructType([T.StructField("_key", T.StringType()), T.StructField("_value", T.StringType()), *inner]))
    fields = [T.StructField(t, pairs) for t in _SIMPLE]
    # a list holds its values directly or in an element of their own
    flat = [T.StructField(t, T.ArrayType(T.StructType([T.StructField("_key", T.StringType()), T.StructField("_value", T.StringType())]))) for t in _SIMPLE]
    listed = T.StructType([T.StructField("_key", T.StringType()), T.StructField("values", T.StructType(flat)), *flat])
    return [*fields, T.StructField("list", T.ArrayType(listed))]


CORRUPT = "_corrupt_record"
TRACE_SCHEMA = T.StructType([*_attributes(DEPTH), T.StructField("event", T.ArrayType(T.StructType(_attributes(DEPTH)))), T.StructField(CORRUPT, T.StringType())])
GLOBAL_SCHEMA = T.StructType([T.StructField("_scope", T.StringType()), *_attributes(0)])

REJECTS = "file string, block_start long, reason string, trace string, event long, attribute string, text string"
#: Characters of a rejected text that a report shows
SHOWN = 200


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block_start, value): the text up to each end of a trace, and where it was read."""
    pieces = spark.read.option("lineSep", TRACE_END).text(path)
    return pieces.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block_start"), "value")


def _begun(value: Column) -> Column:
    """What a piece holds from each beginning of a trace on; all but the last one have no end."""
    parts = F.split(value, r"(?=<trace[\s>])")
    return F.filter(parts, lambda p: p.rlike(r"^<trace[\s>]"))


def _defaults(pieces: DataFrame) -> DataFrame:
    """(file, scope, key, value) of the ``<global>`` elements: some rows per file."""
    heads = pieces.where(F.contains("value", F.lit("<global"))).select("file", F.split("value", r"<trace[\s>]").getItem(0).alias("head"))
    elements = heads.select("file", F.explode(F.expr(r"regexp_extract_all(head, '(?s)<global[\\s>].*?</global>', 0)")).alias("element"))
    parsed = elements.select("file", F.from_xml("element", GLOBAL_SCHEMA).alias("g"))
    pairs = F.concat(*[F.coalesce(F.col(f"g.{t}"), F.array().cast("array<struct<_key:string,_value:string>>")) for t in _SIMPLE])
    found = parsed.select("file", F.col("g._scope").alias("scope"), F.inline(pairs)).where("scope is not null and _key is not null")
    return found.groupBy("file", "scope", F.col("_key").alias("key")).agg(F.min("_value").alias("value"))


def _with_defaults(traces: DataFrame, pieces: DataFrame) -> DataFrame:
    """Maps ``case_defaults`` and ``event_defaults`` of key to value, for each file."""
    entries = F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "value"))))
    given = _defaults(pieces).groupBy("file", "scope").agg(entries.alias("defaults"))
    of = given.groupBy("file").agg(*[F.max(F.when(F.col("scope") == s, F.to_json("defaults"))).alias(n) for s, n in (("trace", "case_defaults"), ("event", "event_defaults"))])
    # a row per file
    of = stage(of, "log-defaults")
    named = traces.join(of, "file", "left")
    return named.withColumns({n: F.from_json(n, "map<string,string>") for n in ("case_defaults", "event_defaults")})


def parse_traces(spark: SparkSession, path: str, spread: int | None = None) -> DataFrame:
    """One row per beginning of a trace: ``file``, ``block_start``, ``reason`` (null if it was read), ``text``, its attributes and defaults.

    ``spread`` deals the traces out to so many tasks before they are parsed, which
    is worth its exchange for compressed files only.
    """
    pieces = read_pieces(spark, path)
    begun = pieces.select("file", "block_start", _begun(F.col("value")).alias("begun"))
    parts = begun.select("file", "block_start", F.size("begun").alias("of"), F.posexplode("begun").alias("at", "text"))
    if spread:
        parts = parts.repartition(spread)
    # only the last one of a piece stands before an end of a trace
    closed = F.col("at") == F.col("of") - 1
    options = {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"}
    parsed = parts.withColumn("trace", F.when(closed, F.from_xml(F.concat("text", F.lit(TRACE_END)), TRACE_SCHEMA, options)))
    reason = F.when(~closed, "no end of the trace").when(F.col(f"trace.{CORRUPT}").isNotNull() | F.col("trace").isNull(), "not well formed")
    fields = [F.col(f"trace.{f.name}").alias(f.name) for f in TRACE_SCHEMA if f.name != CORRUPT]
    found = parsed.select("file", "block_start", reason.alias("reason"), "text", *fields)
    return _with_defaults(found, pieces)


def read_traces(spark: SparkSession, path: str, spread: int | None = None) -> DataFrame:
    """One row per trace that can be read, with its raw attributes; ``.gz`` files are unpacked on the way."""
    return parse_traces(spark, path, spread).where("reason is null").drop("reason", "text")


def rejected_traces(spark: SparkSession, path: str, parsed: DataFrame | None = None) -> DataFrame:
    """The traces, and the ends of files, that are lost: :data:`REJECTS`.

    ``parsed`` is the table of :func:`parse_traces` if it was made already.
    """
    parsed = parse_traces(spark, path) if parsed is None else parsed
    name = F.regexp_extract("text", r'<string\s+key="concept:name"\s+value="([^"]*)"', 1)
    nothing = F.lit(None)
    lost = parsed.where("reason is not null").select(
        "file", "block_start", "reason", F.nullif(name, F.lit("")).alias("trace"), nothing.cast("long").alias("event"),
        nothing.cast("string").alias("attribute"), F.left("text", F.lit(SHOWN)).alias("text"),
    )
    ends = read_pieces(spark, path).groupBy("file").agg(F.max(F.contains("value", F.lit(LOG_END))).alias("ended"), F.max("block_start").alias("block_start"))
    open_files = ends.where("not ended").select(
        "file", "block_start", F.lit("no end of the log").alias("reason"), nothing.cast("string").alias("trace"), nothing.cast("long").alias("event"),
        nothing.cast("string").alias("attribute"), nothing.cast("string").alias("text"),
    )
    return lost.unionByName(open_files)


# --- attributes ------------------------------------------------------------------------


def _none() -> Column:
    return F.array().cast("array<struct<_key:string,_value:string>>")


def _list_text(element: Column) -> Column:
    """The JSON array of a list's values, by type and then in order."""
    values = [F.transform(F.coalesce(holder[t], _none()), lambda a: a["_value"]) for t in _SIMPLE for holder in (element["values"], element)]
    return F.when(element.isNotNull(), F.to_json(F.concat(*values)))


def _named(pairs: Column, key: str) -> Column:
    return F.get(F.filter(pairs, lambda a: a["_key"] == key), F.lit(0))


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed, and stands in the plan, once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _texts(of: Callable[[str], Column], key: str, kinds: Sequence[str], depth: int = DEPTH) -> list[Column]:
    """The texts of an attribute, by its key or by a path of keys, among the attributes ``of`` each kind."""
    found = [_list_text(_named(of(k), key)) if k == "list" else _named(of(k), key)["_value"] for k in kinds]
    first, _, rest = key.partition(PATH)
    if rest and depth:
        # of each kind the elements have the same fields
        outer = F.coalesce(*[_named(of(k), first) for k in _SIMPLE])
        found.append(_bind(outer, lambda o: F.coalesce(*_texts(lambda k: o[k], rest, kinds, depth - 1))))
    return found


def _text(prefix: str, key: str, kinds: Sequence[str], defaults: str | None) -> Column:
    texts = _texts(lambda k: F.col(f"{prefix}{k}"), key, kinds)
    if defaults:
        texts.append(F.try_element_at(F.col(defaults), F.lit(key)))
    return F.coalesce(*texts) if len(texts) > 1 else texts[0]


def _typed(text: Column, kinds: Sequence[str]) -> Column:
    """A text as the widest of the ``kinds``; null where it is no such value."""
    kind = TYPES[widest(kinds)]
    return text if kind == "string" else text.try_cast(kind)


def widest(kinds: Sequence[str]) -> str:
    """The type for an attribute that occurs with several: float holds int, string holds all."""
    if len(set(kinds)) == 1:
        return kinds[0]
    return "float" if set(kinds) == {"int", "float"} else "string"


def _kinds(attributes: Mapping[str, str | Sequence[str]]) -> dict[str, tuple[str, ...]]:
    kinds = {k: (t,) if isinstance(t, str) else tuple(t) for k, t in attributes.items()}
    for name, found in kinds.items():
        if not set(found) <= set(TYPES):
            raise ValueError(f"attribute {name!r} has an unknown type in {found}")
    return kinds


def read_xes(
    spark: SparkSession,
    path: str,
    case_attributes: Mapping[str, str | Sequence[str]],
    event_attributes: Mapping[str, str | Sequence[str]],
    sequence: str = "seq",
    traces: DataFrame | None = None,
) -> DataFrame:
    """One row per event; trace attributes get the prefix ``case:``.

    ``traces`` are those of :func:`read_traces` if they were read already.

    The mappings name the wanted attributes and their types (string, date,
    float, int, boolean, id, list; several where an attribute occurs with several).
    ``sequence`` is the position of the event in its trace.
    """
    kinds, own_kinds = _kinds(case_attributes), _kinds(event_attributes)
    traces = read_traces(spark, path) if traces is None else traces
    events = traces.select("*", F.posexplode("event").alias("__at", "__event"))
    cases = [_typed(_text("", k, t, "case_defaults"), t).alias(f"case:{k}") for k, t in kinds.items()]
    own = [_typed(_text("__event.", k, t, "event_defaults"), t).alias(k) for k, t in own_kinds.items()]
    return events.select(*cases, *own, F.col("__at").cast("long").alias(sequence))


def rejected_cells(
    traces: DataFrame, case_attributes: Mapping[str, str | Sequence[str]], event_attributes: Mapping[str, str | Sequence[str]]
) -> DataFrame:
    """The values that are not of their type, and so become null: :data:`REJECTS`."""

    def cell(prefix: str, key: str, kinds: Sequence[str], defaults: str) -> Column:
        text = _text(prefix, key, kinds, defaults)
        bad = text.isNotNull() & _typed(text, kinds).isNull()
        return F.struct(bad.alias("bad"), F.concat(F.lit("not of type "), F.lit(TYPES[widest(kinds)])).alias("reason"), F.lit(key).alias("attribute"), F.left(text, F.lit(SHOWN)).alias("text"))

    def checked(kinds: Mapping[str, tuple[str, ...]], prefix: str, defaults: str) -> list[Column]:
        return [cell(prefix, k, t, defaults) for k, t in kinds.items() if TYPES[widest(t)] != "string"]

    name = _text("", "concept:name", ("string",), "case_defaults").alias("trace")
    own = ["reason", "trace", "event", "attribute", "text"]
    empty = traces.limit(0).select("file", "block_start", *[F.lit(None).cast("long" if n == "event" else "string").alias(n) for n in own])
    parts = [empty]
    cases = checked(_kinds(case_attributes), "", "case_defaults")
    if cases:
        rows = traces.select("file", "block_start", name, F.lit(None).cast("long").alias("event"), F.inline(F.array(*cases)))
        parts.append(rows.where("bad").select("file", "block_start", *own))
    events = checked(_kinds(event_attributes), "__event.", "event_defaults")
    if events:
        rows = traces.select("*", F.posexplode("event").alias("__at", "__event")).select("file", "block_start", name, F.col("__at").cast("long").alias("event"), F.inline(F.array(*events)))
        parts.append(rows.where("bad").select("file", "block_start", *own))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def list_attributes(spark: SparkSession, path: str, traces: DataFrame | None = None) -> DataFrame:
    """(level, type, key, n): which attributes a log has; those within others by their paths."""
    traces = read_traces(spark, path) if traces is None else traces
    events = traces.select(F.explode("event").alias("e"))

    def listed(df: DataFrame, of: Callable[[str], Column], depth: int, prefix: Column | None) -> DataFrame:
        """(level, type, key, inner): the attributes of a level, with what is within them."""

        def pairs(kind: str) -> Column:
            def entry(a: Column) -> Column:
                key = a["_key"] if prefix is None else F.concat(prefix, F.lit(PATH), a["_key"])
                within = F.struct(*[a[k].alias(k) for k in TYPES]) if depth and kind != "list" else F.lit(None)
                return F.struct(F.lit(kind).alias("type"), key.alias("key"), within.alias("inner"))

            return F.coalesce(F.transform(of(kind), entry), F.array())

        return df.select("level", F.inline(F.concat(*map(pairs, TYPES))))

    def deep(df: DataFrame, level: str, of: Callable[[str], Column]) -> DataFrame:
        found = listed(df.withColumn("level", F.lit(level)), of, DEPTH, None)
        result = found
        for depth in range(DEPTH - 1, -1, -1):
            found = listed(found.where("inner is not null"), lambda k: F.col(f"inner.{k}"), depth, F.col("key"))
            result = result.select("level", "type", "key").unionByName(found.select("level", "type", "key"))
        return result

    both = deep(traces, "case", F.col).unionByName(deep(events, "event", lambda k: F.col(f"e.{k}")))
    return both.groupBy("level", "type", "key").agg(F.count(F.lit(1)).alias("n"))


def attribute_types(spark: SparkSession, path: str, traces: DataFrame | None = None) -> tuple[dict[str, list[str]], dict[str, list[str]]]:
    """Types of the case and of the event attributes: one row per attribute name is collected."""
    levels: dict[str, dict[str, list[str]]] = {"case": {}, "event": {}}
    for row in list_attributes(spark, path, traces).orderBy("level", "key", "type").collect():
        levels[row["level"]].setdefault(row["key"], []).append(row["type"])
    return levels["case"], levels["event"]


def check_share(rejected: int, read: int, most: float, what: str) -> None:
    """Raise if more than a share of ``most`` was rejected."""
    if rejected > most * (rejected + read):
        raise ValueError(f"{rejected} of {rejected + read} {what} cannot be read, more than a share of {most}")


def read_log_checked(spark: SparkSession, path: str, spec: LogSpec, most_rejected: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """The events with the attributes that ``spec`` names, or all that the log has, and what could not be read (:data:`REJECTS`, staged).

    An error if more than a share ``most_rejected`` of the traces is rejected. A gzip
    file is one task until its traces are split, and is then dealt out by traces.
    """
    spread = int(spark.conf.get("spark.sql.shuffle.partitions")) if path.endswith(".gz") else None
    parsed = stage(parse_traces(spark, path, spread), "traces")
    traces = parsed.where("reason is null")
    case, event = spec.xes_case_attributes, spec.xes_event_attributes
    if not event:
        case, event = attribute_types(spark, path, traces)
    rejects = stage(rejected_traces(spark, path, parsed).unionByName(rejected_cells(traces, case, event)), "rejects")
    # a file without an end counts, too: it may have lost traces
    lost = rejects.where("event is null and attribute is null").count()
    check_share(lost, traces.count(), most_rejected, "traces")
    return read_xes(spark, path, case, event, spec.sequence, traces), rejects


def read_log(spark: SparkSession, path: str, spec: LogSpec, most_rejected: float = 0.0) -> DataFrame:
    """The events of a log; an error if more than a share ``most_rejected`` of its traces cannot be read."""
    return read_log_checked(spark, path, spec, most_rejected)[0]
