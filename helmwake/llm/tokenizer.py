"""Byte-level BPE of a public tokenizer, with Spark's higher-order functions.

A text is split into words by the tokenizer's pattern. The distinct words of the
corpus are counted; the frequent ones are folded once, spread over all tasks, and
become a literal of bounded size from which every text reads its words' ids. A
rarer word is folded where it stands. A fold takes the word's bytes and at every
step merges the neighbouring pair of the lowest rank, the leftmost first. The ranks
of the pairs are kept beside the pieces, so a merge looks up two new pairs only. A
word is cut first between two bytes that stand side by side in no token, as no merge
can reach across; so the long words of scripts without spaces are short stretches.
The rank map is a literal (one scalar subquery over the 50,256 entries of the
vocabulary file), spread over small maps by hash.

Words of more than LONG characters would need a quadratic number of copied elements;
such words, and only they, go through the same merges with a heap in an Arrow batch.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Where the vocabulary files of the public tokenizers lie; a parameter of every function.
TOKENIZERS = "/opt/tokenizers"
#: Small maps the rank map is spread over.
BUCKETS = 16384
#: Frequent words of the corpus that are folded once for all texts; the bound of that literal, not of what is encoded.
FREQUENT = 65_536
#: Rank of two bytes that only stand side by side in tokens.
NO_TOKEN = -1
#: Longest word, in characters, that is folded by higher-order functions.
LONG = 400

# Fixed value: the pattern that splits a text into words before the merges.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space as the tokenizer has it, for Java's regular expressions.
_JAVA_SPACE = r"\t\n\x0B\f\r\x20\x85\xA0  -     　"
# possessive quantifiers match the same and keep no way back
JAVA_WORDS = WORDS.replace(r"\p{L}+", r"\p{L}++").replace(r"\p{N}+", r"\p{N}++").replace(r"\p{N}]+", r"\p{N}]++").replace(r"[^\s\p{L}\p{N}]", rf"[^{_JAVA_SPACE}\p{{L}}\p{{N}}]").replace(r"(?!\S)", rf"(?![^{_JAVA_SPACE}])").replace(r"|\s+", rf"|[{_JAVA_SPACE}]+")
_LONG_RUN = rf"\p{{L}}{{{LONG}}}|\p{{N}}{{{LONG}}}|[{_JAVA_SPACE}]{{{LONG}}}|[^{_JAVA_SPACE}\p{{L}}\p{{N}}]{{{LONG}}}"


def read_ranks(name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> dict[bytes, int]:
    """The vocabulary: token bytes to rank, which is also the token's id."""
    with open(f"{folder}/{name}.tiktoken", "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def rank_maps(spark: SparkSession, ranks: dict[bytes, int]) -> DataFrame:
    """One row, ``m``: the rank map as an array of BUCKETS small maps, by hash of the token.

    Two bytes that stand side by side in a token without being one have the rank NO_TOKEN.
    """
    beside = {t[i : i + 2] for t in ranks for i in range(len(t) - 1)}
    both = {p: NO_TOKEN for p in beside} | ranks
    rows = spark.createDataFrame(pd.DataFrame({"t": list(both), "r": list(both.values())}), "t binary, r int")
    return _spread(rows, "t", "r", "m")


def token_bytes(spark: SparkSession, ranks: dict[bytes, int]) -> DataFrame:
    """One row, ``m``: the tokens' bytes in order of id."""
    by_id: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for t, r in ranks.items():
        by_id[r] = t
    rows = spark.createDataFrame(pd.DataFrame({"r": range(len(by_id)), "t": by_id}), "r int, t binary")
    return rows.agg(F.array_sort(F.collect_list(F.struct("r", "t"))).alias("x")).select(F.col("x.t").alias("m"))


def _rank(maps: str, token: str) -> str:
    return f"element_at(get({maps}, cast(xxhash64({token}) & {BUCKETS - 1} AS int)), {token})"


def _fold(maps: str, word: str) -> str:
    """SQL of the ids of one stretch ``word`` (binary), by ranked merges."""
    none = "2147483647"
    pieces = f"transform(sequence(1, octet_length({word})), i -> substring({word}, i, 1))"
    rank = lambda t: f"coalesce(nullif({_rank(maps, t)}, {NO_TOKEN}), {none})"
    # p: the pieces; r: the rank of each piece with the next one; the last has none
    ranks = f"transform(sequence(1, octet_length({word})), i -> IF(i = octet_length({word}), {none}, {rank(f'substring({word}, i, 2)')}))"
    start = f"named_struct('p', {pieces}, 'r', {ranks})"
    place = "cast(array_position(s.r, low) AS int)"
    joined = "concat(get(s.p, at - 1), get(s.p, at))"
    left = f"IF(at = 1, array(), concat(slice(s.r, 1, greatest(at - 2, 0)), array({rank('concat(get(s.p, at - 2), both)')})))"
    here = f"array(IF(at + 1 = size(s.p), {none}, {rank('concat(both, get(s.p, at + 1))')}))"
    merged = f"named_struct('p', concat(slice(s.p, 1, at - 1), array(both), slice(s.p, at + 2, size(s.p))), 'r', concat({left}, {here}, slice(s.r, at + 2, size(s.r))))"
    step = f"(s, i) -> {_let('array_min(s.r)', 'low', f'IF(low = {none}, s, {_let(place, 'at', _let(joined, 'both', merged))})')}"
    folded = f"aggregate(sequence(1, greatest(octet_length({word}) - 1, 1)), {start}, {step}, s -> s.p)"
    return f"transform({folded}, t -> {_rank(maps, 't')})"


def _let(value: str, name: str, body: str) -> str:
    """SQL that computes ``value`` once and uses it as ``name`` in ``body``."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _words(text: str) -> str:
    """SQL of the words of a text column."""
    quoted = "'" + JAVA_WORDS.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"regexp_extract_all(coalesce(`{text}`, ''), {quoted}, 0)"


def _encoded(maps: str, word: str) -> str:
    """SQL of the ids of one word (text): that of the token, or those of the folds of its stretches."""
    rank = _rank(maps, "b")
    cuts = f"filter(sequence(1, octet_length(b) - 1), i -> {_rank(maps, 'substring(b, i, 2)')} IS NULL)"
    parts = "zip_with(concat(array(0), x), concat(x, array(octet_length(b))), (l, h) -> substring(b, l + 1, h - l))"
    stretches = _let(cuts, "x", f"flatten(transform({parts}, y -> {_fold(maps, 'y')}))")
    return _let(f"cast({word} AS binary)", "b", f"IF({rank} >= 0, array({rank}), IF(octet_length(b) < 2, array(), {stretches}))")


def _spread(rows: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """One row, ``out``: an array of BUCKETS small maps from key to value, by hash of the key."""
    b = rows.groupBy(F.expr(f"cast(xxhash64({key}) & {BUCKETS - 1} AS int)").alias("b")).agg(F.map_from_entries(F.collect_list(F.struct(key, value))).alias("m"))
    b = rows.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("b")).join(b, "b", "left")
    return b.agg(F.expr("array_sort(collect_list(struct(b, m)), (x, y) -> x.b - y.b)").alias("x")).select(F.col("x.m").alias(out))


def frequent_words(df: DataFrame, text: str, maps: DataFrame, limit: int = FREQUENT) -> DataFrame:
    """One row, ``c``: the ids of the most frequent words of the column, as an array of small maps.

    Words are counted over all rows with map-side combining. A histogram of the
    counts, eight bins per doubling, gives the count above which at most ``limit``
    words lie, so nothing is sorted. A word below it is folded where it stands.
    """
    w = df.select(F.explode(F.expr(_words(text))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    w = w.where(f"n > 1 AND char_length(w) <= {LONG}").withColumn("bin", F.floor(F.log2("n") * 8))
    h = w.groupBy("bin").agg(F.count("*").alias("k"))
    above = h.select("bin", F.sum("k").over(Window.orderBy(F.desc("bin"))).alias("k"))  # some 500 rows at most
    least = above.where(F.col("k") <= limit).agg(F.min("bin").alias("b")).scalar()
    # spread again, as folding is the work
    top = w.where(F.col("bin") >= least).select("w").repartition(64, "w").withColumn("__m", maps.scalar())
    return _spread(top.select("w", F.expr(_let("__m", "m", _encoded("m", "w"))).alias("i")), "w", "i", "c")


def encode_column(df: DataFrame, text: str, out: str, maps: DataFrame, cache: DataFrame | None = None, known: str = "NULL") -> DataFrame:
    """Adds ``out``, the ids of the column ``text`` (null: none); ``known`` is SQL of the ids of the word ``w`` where they are known already."""
    df = df.withColumn("__m", maps.scalar())
    if cache is not None:
        df, known = df.withColumn("__k", cache.scalar()), f"coalesce({_rank('k', 'w')}, {known})"
    ids = f"flatten(transform({_words(text)}, w -> coalesce({known}, {_encoded('m', 'w')})))"
    ids = _let("__m", "m", ids if cache is None else _let("__k", "k", ids))
    # used once, the literals stay out of the rows
    return df.withColumn(out, F.expr(ids)).drop("__m", "__k")


def heap_merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word with a heap of pairs: n log n steps."""
    n = len(word)
    piece: list[bytes | None] = [word[i : i + 1] for i in range(n)]
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, word[i : i + 2]) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, both = heapq.heappop(heap)
        j = nxt[i] if piece[i] is not None else n
        if j >= n or piece[i] + piece[j] != both:  # one of the two was merged meanwhile
            continue
        piece[i], piece[j] = both, None
        nxt[i] = nxt[j]
        if nxt[j] < n:
            prv[nxt[j]] = i
        for a, b in ((prv[i], i), (i, nxt[i])):
            if a >= 0 and b < n and (r := ranks.get(piece[a] + piece[b])) is not None:
                heapq.heappush(heap, (r, a, piece[a] + piece[b]))
    return [ranks[p] for p in piece if p is not None]


def encode_text(text: str | None, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one text in Python; the same result as the higher-order functions."""
    import regex

    out: list[int] = []
    for w in regex.findall(WORDS, text or ""):
        b = w.encode("utf-8")
        out.extend([ranks[b]] if b in ranks else heap_merge(b, ranks))
    return out


def with_ids(df: DataFrame, text: str = "text", out: str = "ids", name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """Adds ``out``, the token ids (array<int>) of the column ``text``, without special tokens.

    Null and empty texts get an empty list. Strings of special tokens in a text
    are ordinary text. A first pass counts the words and folds the frequent ones
    once; in the second every row is encoded on its own, so no text is shuffled and
    repeated texts, ties and extra columns make no difference.
    """
    ranks = read_ranks(name, folder)
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    # cheap necessary conditions first: a long text, and a long piece without a space, or of spaces
    has_long = (F.length(t) > LONG) & t.rlike(f"[^ ]{{{LONG}}}| {{{LONG}}}") & t.rlike(_LONG_RUN)
    maps = rank_maps(df.sparkSession, ranks)
    cache = frequent_words(df.select(text), text, maps)
    short = encode_column(df.where(~has_long), text, out, maps, cache)

    @F.pandas_udf("array<array<int>>")
    def by_heap(words: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = read_ranks(name, folder)
        for s in words:
            yield s.map(lambda ws: [heap_merge(w.encode("utf-8"), own) for w in ws])

    # only the long words leave the fold
    rest = df.where(has_long).withColumn("__l", F.expr(f"array_distinct(filter({_words(text)}, w -> char_length(w) > {LONG}))"))
    rest = rest.withColumn("__l", F.map_from_arrays("__l", by_heap("__l")))
    return short.unionByName(encode_column(rest, text, out, maps, cache, "element_at(__l, w)").drop("__l"))


def decode(df: DataFrame, ids: str, out: str, name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """Adds ``out``, the text of the ids: their byte pieces joined and read as UTF-8; '' for an empty list, null for null."""
    m = token_bytes(df.sparkSession, read_ranks(name, folder))
    d = df.withColumn("__t", m.scalar())
    text = F.expr(f"decode(unhex(array_join(transform(`{ids}`, i -> hex(get(__t, i))), '')), 'UTF-8')")
    return d.withColumn(out, text).drop("__t")


def document_ids(documents: DataFrame, name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """doc_id and ids of every document."""
    return with_ids(documents.select("doc_id", "text"), "text", "ids", name, folder).select("doc_id", "ids")
