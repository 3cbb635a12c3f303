"""Schemas that drift between the files of a stream.

The footer of a raw file is what its lines hold: field names and JSON kinds, and
of the values their shape and range. The catalogue explodes them to one row per
(stream, file, field, kind). Files get their ordinal in the stream; a run of files
that hold a field with one kind is a lifespan. The changes are the starts and ends
of the lifespans: an end and a start of one field are a change of kind, those of
two fields that carry the same quantity, after the alias table or by shape and
range, one renaming.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helmwake.operators.prefix import distributed_prefix_sum, join_null_safe

# The names under which one quantity is delivered.
ALIASES: dict[str, tuple[str, ...]] = {
    "action": ("action", "Action", "actions", "pose_matrix", "T_w_c", "cam_to_world"),
    "observation.camera_intrinsic": ("observation.camera_intrinsic", "observation.camera_intrinsics", "observation.intrinsics", "camera_intrinsic", "cam_matrix", "K"),
    "observation.camera_extrinsic": ("observation.camera_extrinsic", "observation.camera_extrinsics", "observation.extrinsics", "camera_extrinsic"),
    "timestamp": ("timestamp", "time_stamp", "ts"),
    "frame_index": ("frame_index", "frame_idx", "frame_id"),
}
#: Columns of the consistent table and their types.
TARGET = {"frame_index": "bigint", "timestamp": "double", "action": "array<double>", "observation.camera_intrinsic": "array<double>", "observation.camera_extrinsic": "array<double>"}


def quantity(field: Column, aliases: dict[str, tuple[str, ...]] = ALIASES) -> Column:
    """The quantity a field name stands for; an unknown name stands for itself."""
    names = F.create_map(*[F.lit(x) for q, ns in aliases.items() for n in ns for x in (n, q)])
    return F.coalesce(F.element_at(names, field), field)


def json_kind(schema: Column) -> Column:
    """The JSON kind of a value from the text of schema_of_variant."""
    number = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)"
    return (
        F.when(schema.rlike(number), "number")
        .when(schema == "STRING", "text")
        .when(schema == "BOOLEAN", "truth value")
        .when(schema.startswith("OBJECT"), "object")
        .when(schema.startswith("ARRAY<ARRAY"), "list of lists")
        .when(schema == "ARRAY<STRING>", "list of texts")
        .when(schema == "ARRAY<VOID>", "empty list")
        .when(schema.rlike("^ARRAY<(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)"), "list of numbers")
        .when(schema.startswith("ARRAY"), "mixed list")
    )


def readable(lines: DataFrame) -> DataFrame:
    """The lines whose payload is a JSON object, as the variant ``v``.

    Broken, blank and null lines are left out; so is a line that names a field
    twice, as it has no single value.
    """
    p = lines.withColumn("v", F.try_parse_json("payload"))
    return p.where(F.col("v").isNotNull() & F.schema_of_variant("v").startswith("OBJECT"))


def line_fields(lines: DataFrame) -> DataFrame:
    """(stream, file_id, line_no, field, value): the top-level fields of the readable lines that are not null."""
    v = readable(lines).select("stream", "file_id", "line_no", F.explode(F.col("v").cast("map<string,variant>")).alias("field", "value"))
    return v.where(~F.is_variant_null("value"))


def files(lines: DataFrame) -> DataFrame:
    """(stream, file_id, recorded_at, ord): the files with their place in the stream, from 1.

    Files go by recorded_at, at a tie by file_id; a null recorded_at comes first.
    A stream is counted hour by hour, so a large one is no single task's work.
    """
    f = lines.groupBy("stream", "file_id").agg(F.min("recorded_at").alias("recorded_at"))
    f = f.where("stream IS NOT NULL AND file_id IS NOT NULL").withColumn("one", F.lit(1))
    hour = F.coalesce(F.date_trunc("HOUR", F.col("recorded_at").cast("timestamp")), F.lit("0001-01-01").cast("timestamp"))
    return distributed_prefix_sum(f, ["stream"], hour, ["recorded_at", "file_id"], "one", "ord").drop("one")


#: What tells the quantity behind an unknown name: shape, largest magnitude, and whether any number is negative.
LOOKS = ["shape", "top", "negative"]
#: Ranges of one quantity differ by less than this factor.
RANGE_FACTOR = 4.0


def _looks(value: str, kind: Column) -> list[Column]:
    """LOOKS of a variant column: list lengths per level, or the kind and members; magnitudes of its numbers."""
    get = lambda t: F.expr(f"try_variant_get({value}, '$', '{t}')")
    numbers = F.coalesce(get("array<double>"), F.flatten(get("array<array<double>>")), F.array(get("double")))
    outer = F.size(get("array<variant>"))
    inner = F.size(F.expr(f"try_variant_get({value}, '$[0]', 'array<variant>')"))
    shape = F.concat_ws(" ", kind, outer, inner, F.when(kind == "object", F.schema_of_variant(F.col(value))))
    return [shape.alias("shape"), F.array_max(F.transform(numbers, F.abs)).alias("top"), F.coalesce(F.array_min(numbers) < 0, F.lit(False)).alias("negative")]


def catalogue(lines: DataFrame) -> DataFrame:
    """(stream, file_id, field, kind, *LOOKS): what each file holds.

    A field belongs to a file when any readable line has it and not null. Where a
    file has a field in several kinds, the most frequent counts, at a tie the
    last by name; an empty list counts only where nothing else is.
    """
    kind = json_kind(F.schema_of_variant("value"))
    e = line_fields(lines).select("stream", "file_id", "field", kind.alias("kind"), *_looks("value", kind))
    n = e.groupBy("stream", "file_id", "field", "kind").agg(F.count("*").alias("n"), F.max("shape").alias("shape"), F.max("top").alias("top"), F.bool_or("negative").alias("negative"))
    rank = F.struct(F.col("kind") != "empty list", "n", "kind")
    best = n.groupBy("stream", "file_id", "field").agg(F.max_by(F.struct("kind", *LOOKS), rank).alias("b"))
    return best.select("stream", "file_id", "field", "b.*")


def _spans(lines: DataFrame, order: DataFrame) -> DataFrame:
    """Lifespans with LOOKS at either end: stream, field, kind, first_ord, last_ord, first, last.

    Islands by the lag to the file before and after: every file's entry is counted
    once for itself and once for the ordinals beside it, an aggregation and not a scan
    of the stream in order. Only the islands' edges are put in order: the k-th start
    of a (stream, field, kind) belongs to its k-th end.
    """
    held = join_null_safe(catalogue(lines), order.select("stream", "file_id", "ord"), ["stream", "file_id"])
    look = F.struct(*LOOKS)
    none = F.lit(None).cast("struct<shape:string,top:double,negative:boolean>")
    mark = lambda by, here, before, after: F.struct((F.col("ord") + by).alias("ord"), here.alias("here"), F.lit(before).alias("before"), F.lit(after).alias("after"))
    marks = F.array(mark(0, look, False, False), mark(1, none, True, False), mark(-1, none, False, True))
    m = held.select("stream", "field", "kind", F.inline(marks)).groupBy("stream", "field", "kind", "ord").agg(F.max("here").alias("here"), F.bool_or("before").alias("before"), F.bool_or("after").alias("after"))
    edge = m.where("here IS NOT NULL AND NOT (before AND after)")
    w = Window.partitionBy("stream", "field", "kind").orderBy("ord")
    k = edge.select("*", F.lead(F.struct("ord", "here")).over(w).alias("next")).where("NOT before")
    alone = ~F.col("after")
    return k.select("stream", "field", "kind", F.col("ord").alias("first_ord"), F.when(alone, F.col("ord")).otherwise(F.col("next.ord")).alias("last_ord"), F.col("here").alias("first"), F.when(alone, F.col("here")).otherwise(F.col("next.here")).alias("last"))


def lifespans(lines: DataFrame) -> DataFrame:
    """Runs of successive files that hold a field in one kind: stream, field, kind, first_ord, last_ord."""
    return _spans(lines, files(lines)).drop("first", "last")


def events(lines: DataFrame) -> DataFrame:
    """Starts, ends and changes of kind of every field, against the file before: stream, ord, file_id, field, was, now.

    ``was`` and ``now`` are structs of kind and LOOKS, or null. A stream's first file
    starts nothing, and after its last one nothing ends.
    """
    order = files(lines)
    look = lambda at: F.struct("kind", *[F.col(at)[c].alias(c) for c in LOOKS])
    none = F.lit(None).cast("struct<kind:string,shape:string,top:double,negative:boolean>")
    both = F.array(F.struct(F.col("first_ord").alias("ord"), look("first").alias("now"), none.alias("was")), F.struct((F.col("last_ord") + 1).alias("ord"), none.alias("now"), look("last").alias("was")))
    # one exchange by (stream, ord) serves this aggregation, the join and those of ``changes``
    ends = _spans(lines, order).select("stream", "field", F.inline(both)).where("ord > 1").repartition("stream", "ord")
    pair = ends.groupBy("stream", "ord", "field").agg(F.max("was").alias("was"), F.max("now").alias("now"))
    return pair.join(order.select("stream", "ord", "file_id"), ["stream", "ord"]).select("stream", "ord", "file_id", "field", "was", "now")


def _paired(rows: DataFrame, by: str) -> DataFrame:
    """Ended and started fields of one file that share ``by``, paired in order of name; what has no partner stays single.

    ``gone`` and ``new`` are structs or null; a file's lists hold its changed fields only.
    """
    g = rows.groupBy("stream", "ord", "file_id", by).agg(F.sort_array(F.collect_list("gone")).alias("gone"), F.sort_array(F.collect_list("new")).alias("new"))
    return g.select("stream", "ord", "file_id", by, F.explode(F.arrays_zip("gone", "new")).alias("z")).select("stream", "ord", "file_id", by, F.col("z.gone").alias("gone"), F.col("z.new").alias("new"))


def changes(lines: DataFrame, aliases: dict[str, tuple[str, ...]] = ALIASES) -> DataFrame:
    """All schema changes: file_id, change_kind, old_field, new_field (rows are distinct).

    'added' has an empty old_field, 'removed' an empty new_field; 'retyped' has
    the name in both. A field that ends where another of the same quantity starts
    is 'renamed'. A name outside the alias table counts as the same quantity when
    it ends or starts beside a field of the same shape whose numbers have the same
    range: magnitudes within RANGE_FACTOR, negative numbers in both or neither. Without
    any readable line a file holds no field; a stream's first file changes nothing.
    """
    names = [n for ns in aliases.values() for n in ns]
    f = lambda at: F.struct("field", *[F.col(at)[c].alias(c) for c in LOOKS], F.col("field").isin(names).alias("known"))
    retyped = F.col("was").isNotNull() & F.col("now").isNotNull()
    q = F.when(retyped, F.concat(F.lit("="), F.col("field"))).otherwise(quantity(F.col("field"), aliases))
    ev = events(lines).select("stream", "ord", "file_id", q.alias("q"), F.when(F.col("was").isNotNull(), f("was")).alias("gone"), F.when(F.col("now").isNotNull(), f("now")).alias("new"))
    p = _paired(ev, "q")
    # second round: what stayed single, by looks; only where a name is unknown
    one = F.coalesce("gone", "new")
    done = F.col("gone").isNotNull() & F.col("new").isNotNull()
    alike = F.when(done, F.concat(F.lit("done "), F.col("gone.field"))).otherwise(F.concat_ws(" ", F.lit("looks"), one["shape"], one["negative"].cast("string")))
    p = _paired(p.withColumn("looks", alike), "looks")
    old_top, new_top = F.col("gone.top"), F.col("new.top")
    near = F.coalesce((F.greatest(old_top, new_top) <= RANGE_FACTOR * F.least(old_top, new_top)), old_top.isNull() & new_top.isNull())
    same = done & (F.col("looks").startswith("done") | (near & ~(F.col("gone.known") & F.col("new.known"))))
    change = lambda kind, old, new: F.struct(F.lit(kind).alias("change_kind"), old.alias("old_field"), new.alias("new_field"))
    old, new, empty = F.col("gone.field"), F.col("new.field"), F.lit("")
    out = (
        F.when(same & (old == new), F.array(change("retyped", old, new)))
        .when(same, F.array(change("renamed", old, new)))
        .when(done, F.array(change("removed", old, empty), change("added", empty, new)))
        .when(old.isNotNull(), F.array(change("removed", old, empty)))
        .otherwise(F.array(change("added", empty, new)))
    )
    return p.select("file_id", F.inline(out)).distinct()


def _numbers(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)"), F.lit(1)).cast("array<double>")


def _as_target(target: str, kind: Column, value: str) -> Column:
    """The cast of one value to the target column, by its JSON kind."""
    text = F.expr(f"cast({value} AS string)")
    if TARGET[target] != "array<double>":
        return text.try_cast(TARGET[target])
    num = _numbers(text)
    if target == "observation.camera_intrinsic":
        # an object holds fx, fy, cx, cy; the matrix has them in fixed places
        at = lambda k: F.expr(f"try_variant_get({value}, '$.{k}', 'double')")
        z, one = F.lit(0.0), F.lit(1.0)
        obj = F.array(at("fx"), z, at("cx"), z, at("fy"), at("cy"), z, z, one)
    else:
        t, r = F.expr(f"try_variant_get({value}, '$.t', 'array<double>')"), F.expr(f"try_variant_get({value}, '$.rot', 'array<double>')")
        g = lambda c, i: F.get(c, F.lit(i))
        z, one = F.lit(0.0), F.lit(1.0)
        obj = F.array(g(r, 0), g(r, 1), g(r, 2), g(t, 0), g(r, 3), g(r, 4), g(r, 5), g(t, 1), g(r, 6), g(r, 7), g(r, 8), g(t, 2), z, z, z, one)
    return F.when(kind == "object", obj).otherwise(num)


def consistent_table(lines: DataFrame, aliases: dict[str, tuple[str, ...]] = ALIASES) -> DataFrame:
    """All readable lines in one table: stream, file_id, line_no, the columns of TARGET, and ``other``.

    Fields go to the column of their quantity and are cast to its type: texts and
    nested lists to flat lists of numbers, objects to the matrix they stand for.
    Fields outside the alias table stay in ``other`` (map of JSON texts). Of several
    names of one quantity in a line the first of the alias table counts. A line
    delivered twice comes out once.
    """
    r = readable(lines).withColumn("m", F.map_filter(F.col("v").cast("map<string,variant>"), lambda k, x: ~F.is_variant_null(x)))
    qs = [q for q in aliases if q in TARGET]
    r = r.select("*", *[F.coalesce(*[F.element_at("m", F.lit(n)) for n in aliases[q]]).alias(f"__v{i}") for i, q in enumerate(qs)])
    cols = [_as_target(q, json_kind(F.schema_of_variant(f"__v{i}")), f"__v{i}").alias(q) for i, q in enumerate(qs)]
    known = [n for q, ns in aliases.items() if q in TARGET for n in ns]
    other = F.transform_values(F.map_filter("m", lambda k, x: ~k.isin(known)), lambda k, x: F.to_json(x))
    out = r.select("stream", "file_id", "line_no", "recorded_at", *cols, other.alias("other"))
    return out.groupBy("stream", "file_id", "line_no").agg(*[F.first(f"`{c}`", ignorenulls=True).alias(c) for c in out.columns[3:]])
