"""Brand terms kept in a table: a query is branded when it contains any of them.

A term is found in two steps, whatever the list looks like. Its first letters tell which lengths terms with this start
have; then the text is cut to each of these lengths and looked up as a whole. So a place of a text costs as many lookups
as there are lengths, and terms that share a start, however many, are never tried one by one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

#: The start of a term has so many letters, at most.
KEY_LETTERS = 4
#: Bytes of terms that may travel in the plan; a longer list is refused there and goes through the join.
INDEX_BYTES = 16 << 20
#: Texts are read in pieces of so many places, since cutting at a place costs the way to it.
PIECE = 256
#: Bits for a term in the filter before the join, bytes it has at most, and bits in one of its chunks.
FILTER_BITS = 64
FILTER_BYTES = 16 << 20
CHUNK_BITS = 1 << 16


def clean_terms(terms: DataFrame) -> DataFrame:
    """Lowercase distinct terms without empty ones."""
    lowered = terms.select(F.lower("term").alias("term"))
    return lowered.where(F.length("term") > 0).distinct()


def _key(term: Column) -> Column:
    return F.substring(term, 1, KEY_LETTERS)


def _starts(terms: DataFrame) -> DataFrame:
    """The lengths that the terms with each start have."""
    return terms.groupBy(_key(F.col("term")).alias("key")).agg(F.array_sort(F.collect_set(F.length("term"))).alias("lengths"))


def _begins(text: Column) -> Column:
    return F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), F.lit(PIECE))


def _piece(text: Column, begin: Column, longest: Column) -> Column:
    return F.substring(text, begin, longest + PIECE - 1)


def _pieces(text: Column, longest: Column) -> Column:
    """Pieces of a text that begin every PIECE places and run on so far that each term is whole in one."""
    return F.transform(_begins(text), lambda begin: _piece(text, begin, longest))


def _places(piece: Column) -> Column:
    return F.sequence(F.lit(1), F.greatest(F.least(F.length(piece), F.lit(PIECE)), F.lit(1)))


def _bucketed(rows: DataFrame, key: str, value: Column, size: Column, out: str) -> DataFrame:
    return rows.groupBy(F.pmod(F.xxhash64(key), size).alias("bucket")).agg(F.collect_list(value).alias(out))


def term_index(terms: DataFrame) -> DataFrame:
    """One row: terms and starts of terms in buckets by their hash, the lengths of starts, and that of the longest term.

    There are twice as many buckets as terms, so a lookup meets about one entry, however long the list is.
    """
    size = terms.agg(F.count("*") * 2 + 1).scalar()
    whole = _bucketed(terms, "term", F.col("term"), size, "terms")
    starts = _bucketed(_starts(terms), "key", F.struct("key", "lengths"), size, "starts")
    numbers = terms.sparkSession.range(1).select(F.explode(F.sequence(F.lit(0).cast("bigint"), size - 1)).alias("bucket"))
    filled = numbers.join(whole, "bucket", "left").join(starts, "bucket", "left")
    row = F.struct("bucket", F.coalesce("terms", F.array()).alias("terms"), F.coalesce("starts", F.array()).alias("starts"))
    buckets = F.transform(F.sort_array(F.collect_list(row)), lambda r: F.struct(r["terms"].alias("terms"), r["starts"].alias("starts")))
    total = terms.agg(F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).scalar()
    checked = F.when(total <= INDEX_BYTES, buckets).otherwise(F.raise_error(F.lit(f"more than {INDEX_BYTES} bytes of terms: use by_join")))
    lengths = terms.agg(F.collect_set(F.length(_key(F.col("term"))))).scalar()
    longest = terms.agg(F.coalesce(F.max(F.length("term")), F.lit(0))).scalar()
    return filled.agg(F.struct(checked.alias("buckets"), lengths.alias("lengths"), longest.alias("longest")).alias("index"))


def _flag_by_index(df: DataFrame, terms: DataFrame, text: str, out: str) -> DataFrame:
    # The index is a scalar subquery, run with the query. A row looks up each of its places, so its cost follows
    # the length of its text and not the length of the list; no row is exchanged.
    def bucket(x: Column, found: Column, of: str) -> Column:
        buckets = x["index"]["buckets"]
        return F.get(buckets, F.pmod(F.xxhash64(found), F.size(buckets)).cast("int"))[of]

    def at(x: Column, piece: Column, place: Column) -> Column:
        def whole(length: Column) -> Column:
            found = F.substring(piece, place, length)
            return F.exists(bucket(x, found, "terms"), lambda term: term == found)

        def start(k: Column) -> Column:
            found = F.substring(piece, place, k)
            return F.exists(bucket(x, found, "starts"), lambda s: (s["key"] == found) & F.exists(s["lengths"], whole))

        return F.exists(x["index"]["lengths"], start)

    # Named once and used once, the index is put where it is used and never becomes a column of rows.
    listed = df.withColumn("brand_index", term_index(terms).scalar())
    both = F.array(F.struct(F.col("brand_index").alias("index"), F.lower(F.col(text)).alias("text")))
    hit = F.exists(both, lambda x: F.exists(_pieces(x["text"], x["index"]["longest"]), lambda piece: F.exists(_places(piece), lambda place: at(x, piece, place))))
    return listed.withColumn(out, F.coalesce(hit, F.lit(False))).drop("brand_index")


def term_filter(terms: DataFrame) -> DataFrame:
    """One row: bits by which most places of a text are seen to begin no term, and the lengths of starts and terms.

    Two bits stand for each start and for each start with a length of its terms, four for each term. There are
    FILTER_BITS bits for a term up to FILTER_BYTES; beyond, more cuts pass by chance, and the join looks them up.
    """
    chunks = terms.agg(F.least(F.ceil(F.count("*") * FILTER_BITS / CHUNK_BITS) + 1, F.lit(FILTER_BYTES * 8 // CHUNK_BITS)).cast("bigint")).scalar()
    key, length = _key(F.col("term")), F.length("term")
    hashes = (F.xxhash64(key), F.xxhash64(key, length), *_whole_hashes(F.col("term")))
    marks = terms.select(F.explode(F.array(*[bit for h in hashes for bit in _bits(h, chunks * CHUNK_BITS)])).alias("bit"))
    value = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit").bitwiseAND(63).cast("int"))
    numbers = F.explode(F.sequence(F.lit(0).cast("bigint"), chunks * (CHUNK_BITS // 64) - 1)).alias("word")
    every = terms.sparkSession.range(1).select(numbers, F.lit(0).cast("bigint").alias("value"))
    words = marks.select(F.shiftright("bit", 6).alias("word"), value.alias("value")).unionByName(every)
    words = words.groupBy("word").agg(F.bit_or("value").alias("value"))

    def in_order(number: str) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.struct(number, "value"))), lambda r: r["value"]).alias("value")

    rows = words.groupBy(F.expr(f"word div {CHUNK_BITS // 64}").alias("chunk")).agg(in_order("word")).agg(in_order("chunk"))
    starts = terms.agg(F.collect_set(F.length(key))).scalar()
    lengths = terms.agg(F.array_sort(F.collect_set(length))).scalar()
    longest = terms.agg(F.coalesce(F.max(length), F.lit(0))).scalar()
    return rows.select(
        F.struct(F.col("value").alias("chunks"), (chunks * CHUNK_BITS).alias("size"), starts.alias("starts"), lengths.alias("lengths"), longest.alias("longest"))
    )


def _whole_hashes(term: Column) -> tuple[Column, Column]:
    return F.xxhash64(term), F.xxhash64(term, F.lit(0))


def _bits(h: Column, size: Column) -> tuple[Column, Column]:
    return F.pmod(h, size), F.pmod(F.shiftright(h, 29), size)


def _may_be(index: Column, h: Column) -> Column:
    def is_set(bit: Column) -> Column:
        chunk = F.get(index["chunks"], F.shiftright(bit, CHUNK_BITS.bit_length() - 1).cast("int"))
        word = F.get(chunk, F.shiftright(bit, 6).bitwiseAND(CHUNK_BITS // 64 - 1).cast("int"))
        return F.getbit(word, bit.bitwiseAND(63).cast("int")) == 1

    one, other = _bits(h, index["size"])
    return is_set(one) & is_set(other)


def _may_start(index: Column, piece: Column, place: Column, size: Column) -> Column:
    return _may_be(index, F.xxhash64(F.substring(piece, place, size)))


def _may_be_term(index: Column, piece: Column, place: Column, size: Column, length: Column) -> Column:
    known = _may_be(index, F.xxhash64(F.substring(piece, place, size), length))
    one, other = _whole_hashes(F.substring(piece, place, length))
    return known & _may_be(index, one) & _may_be(index, other)


def _first_of(items: Column, find: Callable[[Column], Column]) -> Column:
    """The first text that is found; nothing is looked for behind it."""
    return F.aggregate(items, F.lit(None).cast("string"), lambda found, item: F.coalesce(found, find(item)))


def _first_cut(index: Column, text: Column) -> Column:
    """The text with its first cut that the filter lets pass, in an array; empty where there is none."""

    def at(x: Column, piece: Column, place: Column) -> Column:
        def of_length(size: Column, length: Column) -> Column:
            return F.when(_may_be_term(x["index"], piece, place, size, length), F.substring(piece, place, length))

        def of_start(size: Column) -> Column:
            whole = _first_of(x["index"]["lengths"], lambda length: of_length(size, length))
            return F.when(_may_start(x["index"], piece, place, size), whole)

        return _first_of(x["index"]["starts"], of_start)

    def within(x: Column, piece: Column) -> Column:
        return _first_of(_places(piece), lambda place: at(x, piece, place))

    def of_text(x: Column) -> Column:
        cut = lambda begin: F.array(_piece(x["text"], begin, x["index"]["longest"]))
        return _first_of(_begins(x["text"]), lambda begin: _first_of(cut(begin), lambda piece: within(x, piece)))

    # As in the lookup by index: the filter is named once, where it is used.
    both = F.array(F.struct(index.alias("index"), text.alias("text")))
    return F.filter(F.transform(both, lambda x: F.struct(x["text"].alias("text"), of_text(x).alias("term"))), lambda r: r["term"].isNotNull())


def _all_cuts(index: Column, text: Column) -> Column:
    """All distinct cuts of a text that the filter lets pass."""

    def at(x: Column, piece: Column, place: Column, size: Column) -> Column:
        lengths = F.filter(x["index"]["lengths"], lambda length: _may_be_term(x["index"], piece, place, size, length))
        return F.transform(lengths, lambda length: F.substring(piece, place, length))

    def within(x: Column, piece: Column) -> Column:
        def starts(place: Column) -> Column:
            return F.filter(x["index"]["starts"], lambda size: _may_start(x["index"], piece, place, size))

        places = F.filter(_places(piece), lambda place: F.size(starts(place)) > 0)
        return F.flatten(F.transform(places, lambda place: F.flatten(F.transform(starts(place), lambda size: at(x, piece, place, size)))))

    def of_text(x: Column) -> Column:
        return F.flatten(F.transform(_pieces(x["text"], x["index"]["longest"]), lambda piece: within(x, piece)))

    return F.array_distinct(F.flatten(F.transform(F.array(F.struct(index.alias("index"), text.alias("text"))), of_text)))


def _flag_by_join(df: DataFrame, terms: DataFrame, text: str, out: str) -> DataFrame:
    # A bounded filter, sent along, leaves out places that begin no term. The first cut that passes meets the terms in an
    # equi-join. Nearly always it is one, and its text is done; of the other texts all cuts that pass meet the terms.
    # Each distinct text is cut once, and exchanged once more by its cut. Texts go by two hashes of 64 bits.
    def named(x: Column) -> Column:
        return F.struct(F.xxhash64(x), F.xxhash64(F.lit(1), x))

    # Filter and text are named once and used once, so the filter is put where it is used and is no column of rows.
    index, lowered = F.col("brand_index"), F.col("text")
    texts = df.select(F.lower(text).alias("text")).where(F.col("text").isNotNull()).distinct()
    listed = texts.withColumn("brand_index", term_filter(terms).scalar())
    # Exploding a changed array keeps Spark from filtering by its size, for which all cuts would be worked out again.
    first = listed.select(_first_cut(index, lowered).alias("cut")).select(F.inline(F.array_compact("cut")))
    # Terms lie by term where they were made distinct. A key of another kind has them exchanged for the join itself, which
    # lets Spark split a cut that many texts have.
    known = terms.select(F.struct("term").alias("cut"), F.lit(True).alias("known"))
    met = first.withColumn("cut", F.struct("term")).join(known, "cut", "left").drop("cut")
    again = met.withColumn("brand_index", term_filter(terms).scalar())
    cuts = F.when(F.col("known"), F.array("term")).otherwise(_all_cuts(index, lowered))
    held = again.select(named(lowered).alias("__branded"), cuts.alias("cuts"))
    held = held.select("__branded", F.explode(F.array_compact("cuts")).alias("term")).select("__branded", F.struct("term").alias("cut"))
    held = held.join(known, "cut", "left_semi")
    hits = held.select("__branded").distinct().withColumn(out, F.lit(True))
    # The hashes are a column of their own, so a text that is not asked for later is not exchanged.
    flagged = df.withColumn("__branded", named(F.lower(text))).join(hits, "__branded", "left").drop("__branded")
    return flagged.withColumn(out, F.coalesce(F.col(out), F.lit(False)))


def flag_branded(
    df: DataFrame, terms: DataFrame, text: str = "query", out: str = "is_branded", by_join: bool | None = False
) -> DataFrame:
    """Adds whether the text contains any term, ignoring case; every input row stays, once.

    One lazy plan, whatever the list's size. ``by_join`` is for lists beyond INDEX_BYTES: it exchanges texts instead of
    sending the list along. None takes the one that fits: the list's bytes are added up first, in a job of its own.
    """
    listed = clean_terms(terms)
    if by_join is None:
        total = listed.agg(F.sum(F.octet_length("term"))).first()[0] or 0
        by_join = total > INDEX_BYTES
    how = _flag_by_join if by_join else _flag_by_index
    return how(df, listed, text, out)
