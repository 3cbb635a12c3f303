"""Records that differ only in formatting, by progressive partition refinement.

Level 1 groups records by cheap invariants of formatting: the number of letters and
a histogram of them, without parsing and without sorting. Only (class, count) is
shuffled; the classes with several members become a Bloom filter of bounded size,
which every task probes with its own records. Level 2 computes the full key, which
parses JSON, only for records that pass, where they stand. Level 3 is the key's
128-bit digest, by which copies are aggregated; no text is ever shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helmwake.operators.orphans import MAX_WORDS, bloom_words, maybe_among

#: White space, punctuation, symbols, controls and invisible format characters.
SEPARATORS = r"[\s\p{Z}\p{P}\p{S}\p{C}]+"
#: What stands between two digits without white space is content: 2.5, 7:33, 10-20.
MARK_IN_NUMBER = r"(?<=\p{Nd})([^\s\p{Z}\p{Nd}\p{L}\p{M}\p{C}])(?=\p{Nd})"
#: Control characters by which the protected marks are kept apart from all text.
OPEN, CLOSE, FIELD = "\u0001", "\u0002", "\u0003"


def plain_key(text: Column) -> Column:
    """The text without letter case, white space and punctuation.

    A mark between two digits is kept with its digits. Digits that a separator
    parts stay apart ('1, 2' is not '12'); apart from that separators vanish.
    """
    t = F.translate(text, OPEN + CLOSE + FIELD, "   ")
    t = F.regexp_replace(t, MARK_IN_NUMBER, OPEN + "$1" + CLOSE)
    return _let(F.split(t, OPEN), _spelt)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _spelt(parts: Column) -> Column:
    """The stripped text around protected marks, of which each part but the first begins with one."""
    first = _strip(F.element_at(parts, 1))
    rest = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: F.concat(F.lit(OPEN), F.substring_index(p, CLOSE, 1), F.lit(CLOSE), _strip(p.substr(F.locate(CLOSE, p) + 1, F.length(p)))))
    return F.when(F.size(parts) <= 1, first).otherwise(F.concat(first, F.concat_ws("", rest)))


def _strip(t: Column) -> Column:
    apart = F.regexp_replace(t, r"(?<=\p{Nd})" + SEPARATORS + r"(?=\p{Nd})", FIELD)
    return F.upper(F.regexp_replace(apart, r"[\s\p{Z}\p{P}\p{S}&&[^\u0003]]+|[\p{C}&&[^\u0003]]+", ""))


def _looks_json(text: Column) -> Column:
    return text.rlike(r"^[\s\p{Z}]*[\[{]")


def json_text(text: Column) -> Column:
    """The record as canonical JSON (fields sorted, no layout, no escapes), or null when it is no JSON object or list.

    A JSON value with one field named twice is no JSON here and is compared as text.
    """
    v = F.try_parse_json(F.translate(text, "\t\n\r\u0085  　", " " * 7))
    return F.when(_looks_json(text), F.to_json(v))


def json_key(canonical: Column) -> Column:
    """The skeleton of canonical JSON and the plain keys of its strings, in order."""
    literal = r'"(?:[^"\\]|\\.)*"'
    skeleton = F.regexp_replace(canonical, literal, '"')
    strings = F.regexp_extract_all(canonical, F.lit(literal), F.lit(0))
    bare = F.transform(strings, lambda s: plain_key(F.regexp_replace(s, r"\\(u[0-9a-fA-F]{4}|.)", " ")))
    return F.concat(F.lit("J"), skeleton, F.lit(OPEN), F.concat_ws(OPEN, bare))


def full_key(text: Column) -> Column:
    """The costly key: two records are copies when it is equal."""
    return F.coalesce(_let(json_text(text), json_key), F.concat(F.lit("T"), plain_key(text)))


#: Letters that the histogram counts one by one; E stands in the notation of numbers and is left out.
HISTOGRAM = "AINORSTLDU"


def cheap_key(text: Column) -> Column:
    """Invariant under all formatting: a digest of the number of letters and of how often each occurs, in any script.

    Letters are counted in upper case, as some have two there. The histogram holds
    the Latin letters, those of HISTOGRAM each by itself, and the others' number and
    sum of hashes, so nothing is sorted. Digits and E are left out, as JSON numbers have several
    spellings. JSON is counted by its raw letters; it is parsed only where it holds
    a backslash, behind which a letter may be another one's escape.
    """
    raw = F.when(text.contains("\\") & _looks_json(text), F.regexp_replace(json_text(text), r"\\(u[0-9a-fA-F]{4}|.)", " "))
    t = F.upper(F.coalesce(raw, text))
    latin = F.regexp_replace(t, "[^A-DF-Z]+", "")
    counts = [F.octet_length(latin) - F.octet_length(F.replace(latin, F.lit(c), F.lit(""))) for c in HISTOGRAM]
    rest = F.regexp_replace(t, r"[\x00-\x7F]+|[^\p{L}]", "")
    hashes = F.aggregate(F.split(rest, ""), F.lit(0).cast("bigint"), lambda a, c: a + F.shiftright(F.xxhash64(c), 16))
    return F.xxhash64(F.octet_length(latin), *counts, F.when(F.octet_length(t) > F.length(t), F.when(F.length(rest) > 0, F.xxhash64(F.length(rest), hashes))))


def blank(text: Column) -> Column:
    """True for a null text and for one without any visible character."""
    return F.coalesce(F.regexp_replace(text, r"[\s\p{Z}\p{C}]+", "") == "", F.lit(True))


def _classes(records: DataFrame, key: str, text: str, words: int = MAX_WORDS) -> DataFrame:
    """(id, k): the class digest of every record that may share its cheap key with another; the rest is left out.

    The filter may let a single record pass; it gets a class of its own.
    """
    r = records.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("t")).where(~blank(F.col("t")) & F.col("id").isNotNull())
    r = r.withColumn("c", cheap_key(F.col("t")))
    # counts of the cheap key combine inside each task: a class with a third of all rows costs no task more
    several = r.groupBy("c").agg(F.count("*").alias("n")).where("n > 1").select("c")
    inside = maybe_among(r, "c", bloom_words(several, "c", words), words)
    return inside.select("id", F.md5(full_key(F.col("t"))).alias("k"))


def copies(records: DataFrame, key: str = "task_index", text: str = "task") -> DataFrame:
    """One row per surplus copy: task_index_a is the smallest key of its group, task_index_b another one.

    Copies differ in nothing but white space, letter case, punctuation, the order
    of the fields of JSON objects, and layout and escapes of JSON. Null and blank
    records are no cases; a key that comes twice with the same text is one record;
    an empty table gives no rows; other columns are ignored.
    """
    c = _classes(records, key, text).distinct()
    lowest = c.groupBy("k").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 1").select("k", "a")
    j = c.join(lowest, "k").where("id <> a")
    return j.select(F.col("a").alias("task_index_a"), F.col("id").alias("task_index_b")).distinct()


def collapse(records: DataFrame, key: str = "task_index", text: str = "task") -> DataFrame:
    """One row per distinct record: the smallest key, its text and the number of copies, itself included.

    Null and blank records form no group and come out one by one with n_copies 1.
    """
    surplus = copies(records, key, text)
    size = surplus.groupBy(F.col("task_index_a").alias(key)).agg((F.count("*") + 1).alias("n_copies"))
    kept = records.select(key, text).join(surplus.select(F.col("task_index_b").alias(key)), key, "left_anti")
    return kept.join(size, key, "left").select(key, text, F.coalesce("n_copies", F.lit(1)).cast("bigint").alias("n_copies"))
