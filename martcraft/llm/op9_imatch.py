"""Operator 9: I-Match fingerprints over randomised lexicon subsets (DataFrame functions only).

A text's terms are its distinct lower-cased words.  The lexicon holds the terms whose
document frequency lies in a band [lo, hi] of all distinct texts; its size is at most
the mean number of terms of a text divided by ``lo``, whatever the number of texts,
so it may be broadcast.  A second hash deals the lexicon at random into
2 ** b subsets, b following the text's number of terms so that a subset holds about
one of them, and the first ``SUBSETS`` of these are used.  The hash of a text's terms in
a subset is the exclusive or of the term hashes, which is that of the sorted distinct
terms in any order.  The fingerprint joins these hashes, at two neighbouring subset
sizes so that texts of similar length share one.

The subsets sample a text's terms (64 of at least ``distinct words`` subsets).  So the
fingerprint begins with the hash of all the text's terms in the lexicon, and with those
of its terms in ``WIDE`` randomised lexicons that keep three quarters of the terms each:
texts that differ in any term of the lexicon have different fingerprints, and texts
that differ in a few share some of the wide hashes.

Likeness of two fingerprints: the share of equal hashes among the subsets with a term of
either text, or among the wide lexicons, whichever is greater, the hash of all terms
counted in both (so only texts with equal lexicon terms have likeness 1); 0 if the texts
differ in size beyond a factor of two to four.

The next document comes from one shuffle: ids are dealt by blocks of ``span``, and
each block gets a copy of the document that follows it, so that a window sees the
text after each text.  All later grouping stays within the blocks' partitions: a word that a text
and its edit share is hashed and looked up once, and one aggregate keyed by the row's place holds
all hashes of both as longs.

Nulls and edge cases: a null text is empty; a text without a term in the lexicon has
the fingerprint of its word sequence, alike (1) only if equal; rows that repeat an id
follow each other by text; null ids sort after all others, by a hash of their text; a single document is its
own next one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from martcraft.session import materialize

SUBSETS = 64
WIDE = 8                    # two bits of a term's hash each, from bit 48 on; the subsets use the low 41
LO, HI = 0.001, 0.2
_MARK = "\n"                # no word: keeps a row of every text through the lexicon join


def words(text: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), ""))


def lexicon(docs: DataFrame, text_col: str = "text", lo: float = LO, hi: float = HI) -> DataFrame:
    """term (64-bit hash) of every term with a document frequency in the band (2 texts at least).

    Equal texts count once, or a large group of copies would push its terms out of the band."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.xxhash64(text).alias("h"), F.length(text).alias("size"),
                        F.array_join(words(text), " ").alias("ws"))
    n = keyed.select("h", "size").distinct().count()
    # copies meet in the tasks that read them, so a hot text sends one row per task
    once = keyed.groupBy("h", "size").agg(F.first("ws").alias("ws")).where("ws <> ''")
    terms = once.select(F.explode(F.split("ws", " ")).alias("w")).select(F.xxhash64("w").alias("term"))
    return (terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
            .where((F.col("df") >= max(2.0, lo * n)) & (F.col("df") <= max(2.0, hi * n))).select("term"))


def _next_lower(keys: DataFrame, span: int, levels: int) -> DataFrame:
    """(k, nxt): the next smaller key of each distinct key; null for the smallest."""
    g = F.floor(F.col("k") / span)
    if levels <= 0:
        return keys.select("k", F.lead("k").over(W.partitionBy(g * 0).orderBy(F.desc("k"))).alias("nxt"))
    near = keys.select("k", g.alias("g"), F.lead("k").over(W.partitionBy(g).orderBy(F.desc("k"))).alias("own"))
    heads = keys.groupBy(g.alias("g")).agg(F.max("k").alias("head"))
    over = _next_lower(heads.select(F.col("g").alias("k")), span, levels - 1)
    jump = over.join(heads, over.nxt == heads.g).select(over.k.alias("g"), "head")
    return near.join(jump, "g", "left").select("k", F.coalesce("own", "head").alias("nxt"))


def with_next(docs: DataFrame, id_col: str, text_col: str, span: int = 64) -> DataFrame:
    """(block, ord, id, text, after, extra): each text with the following one, descending id, cyclic.

    Rows with ``extra`` are the copies at the end of a block and belong to no document."""
    low, high, nameless = docs.agg(F.min(id_col), F.max(id_col), F.count_if(F.col(id_col).isNull())).first()
    low, high = (low or 0), (high or 0)
    # rows without an id take keys below all ids by a hash of their text, about one row to a key
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(low - 1) - F.pmod(F.xxhash64(text_col), F.lit(max(nameless, 1))))
    rows = docs.select(F.floor(key / span).alias("block"), key.alias("key"), F.col(id_col).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    heads = materialize(rows.groupBy("block").agg(F.max(F.struct("key", "text")).alias("head")))
    levels, reach = 0, (high - low + 1 + nameless) // span + 2
    while reach > span:
        levels, reach = levels + 1, reach // span + 1
    follow = _next_lower(heads.select(F.col("block").alias("k")), span, levels).select(
        F.col("k").alias("block"), F.coalesce("nxt", F.lit(high // span)).alias("nb"))
    copies = follow.join(heads.select(F.col("block").alias("nb"), "head.text"), "nb").select(
        "block", F.lit(None).cast("long").alias("key"), F.lit(None).cast(rows.schema["id"].dataType).alias("id"),
        "text", F.lit(True).alias("extra"))
    both = rows.withColumn("extra", F.lit(False)).unionByName(copies)
    w = W.partitionBy("block").orderBy("extra", F.desc("key"), F.desc("text"))
    return both.select("block", F.row_number().over(w).alias("ord"), "id", "text",
                       F.lead("text").over(w).alias("after"), "extra")


def _hash_table(lex: DataFrame) -> DataFrame:
    """term, u (which subsets), x (its hash) and its 16-bit parts in the wide lexicons, four to a long; with the mark."""
    u = F.xxhash64("term", F.lit(9))
    zero = F.lit(0).cast("long")
    lanes = [sum((F.when(F.shiftright(u, 48 + 2 * i).bitwiseAND(F.lit(3)) != 0, F.col("term").bitwiseAND(
        F.lit(0xFFFF << 16 * (i % 4) if i % 4 < 3 else -1 << 48))).otherwise(zero)
        for i in range(at, at + 4)), zero) for at in range(0, WIDE, 4)]
    return lex.select("term", u.alias("u"), F.col("term").alias("x"), *(c.alias(f"x{i}") for i, c in enumerate(lanes))).union(
        lex.sparkSession.range(1).select(F.xxhash64(F.lit(_MARK)).alias("term"), F.lit(None).cast("long").alias("u"), zero,
                                         *[zero] * len(lanes)))


def _prints(rows: DataFrame, lex: DataFrame, carry: list[str], sides: tuple[str, ...]) -> DataFrame:
    """rows (block, ord, carry, one text per side) -> block, ord, carry and per side a struct of base, near, far (arrays
    of subset hashes at two sizes), wide (hash of all terms, then of those in each wide lexicon), terms (terms in the
    lexicon) and whole (hash of the word sequence).

    A word that two sides share is one row.  (block, ord) is the only key and all state is longs: the 64
    subset hashes of a size are 16 longs of four each, so a task's aggregate has one row per document.  The carried
    columns are the same in all rows of a key."""
    zero = F.lit(0).cast("long")
    counted = rows.select("block", "ord", *carry, *(words(F.coalesce(F.col(s), F.lit(""))).alias(f"ws_{s}") for s in sides))
    for s in sides:
        counted = counted.withColumns({
            f"base_{s}": F.least(F.lit(40), F.floor(F.log2(F.size(f"ws_{s}") + F.lit(1.0))).cast("int") + 1),
            f"whole_{s}": F.xxhash64(f"ws_{s}")})
    kept = [*carry, *(f"{n}_{s}" for s in sides for n in ("base", "whole"))]
    # which sides hold a word: a bit each
    if len(sides) == 1:
        parts = [(1, F.col(f"ws_{sides[0]}"))]
    else:
        a, b = (F.col(f"ws_{s}") for s in sides)
        parts = [(3, F.array_intersect(a, b)), (1, F.array_except(a, b)), (2, F.array_except(b, a))]
    parts[0] = (parts[0][0], F.array_append(parts[0][1], F.lit(_MARK)))
    dealt = counted.select("block", "ord", *kept, F.explode(F.array(*(
        F.struct(F.lit(bits).alias("bits"), ws.alias("ws")) for bits, ws in parts))).alias("p"))
    out = dealt.select("block", "ord", *kept, "p.bits", F.explode("p.ws").alias("w")).select(
        "block", "ord", *kept, "bits", F.xxhash64("w").alias("term"))
    joined = out.join(F.broadcast(_hash_table(lex)), "term")
    # the subset of a term at either size (-1: none of those used) and its hash at that place of a long
    held, sums, aggs = {}, {}, [F.max(c).alias(c) for c in kept]
    for k, s in enumerate(sides):
        has = F.col("bits").bitwiseAND(F.lit(1 << k)) != 0
        for size, more in (("n", 0), ("f", 1)):
            at = F.expr(f"u & (shiftleft(1L, base_{s} + {more}) - 1)")
            held[f"{size}_{s}"] = F.when(has & (at < SUBSETS), at.cast("int")).otherwise(F.lit(-1))
            sums[f"v{size}_{s}"] = F.expr(f"shiftleft(x & 65535L, 16 * ({size}_{s} & 3))")
            aggs += [F.bit_xor(F.when(F.shiftright(f"{size}_{s}", 2) == j, F.col(f"v{size}_{s}")).otherwise(zero)).alias(
                f"{size}{j}_{s}") for j in range(SUBSETS // 4)]
        for x in ["x", *(f"x{i}" for i in range(WIDE // 4))]:
            sums[f"{x}_{s}"] = F.when(has, F.col(x)).otherwise(zero)
            aggs.append(F.bit_xor(f"{x}_{s}").alias(f"{x}_{s}"))
        sums[f"one_{s}"] = F.when(has & F.col("u").isNotNull(), F.lit(1).cast("long")).otherwise(zero)
        aggs.append(F.sum(f"one_{s}").alias(f"terms_{s}"))
    placed = joined.select("*", *(c.alias(n) for n, c in held.items())).select(
        "block", "ord", *kept, *held, *(c.alias(n) for n, c in sums.items()))
    got = placed.groupBy("block", "ord").agg(*aggs)

    def unpacked(longs: Column, n: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.call_function(
            "shiftrightunsigned", F.get(longs, F.floor(k / 4).cast("int")), 16 * (k % 4)).bitwiseAND(F.lit(0xFFFF)).cast("int"))

    def print_of(s: str) -> Column:
        longs = lambda size: F.array(*(f"{size}{j}_{s}" for j in range(SUBSETS // 4)))
        wide = F.array(*(f"x{i}_{s}" for i in range(WIDE // 4)))
        return F.struct(F.col(f"terms_{s}").alias("terms"), F.col(f"base_{s}").alias("base"),
                        unpacked(longs("n"), SUBSETS).alias("near"), unpacked(longs("f"), SUBSETS).alias("far"),
                        F.concat(F.array(f"x_{s}"), unpacked(wide, WIDE).cast("array<long>")).alias("wide"),
                        F.col(f"whole_{s}").alias("whole")).alias(f"p_{s}")

    return got.select("block", "ord", *carry, *(print_of(s) for s in sides))


def _text(p: Column) -> Column:
    """Fingerprint as a string."""
    hexed = lambda a: F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 4, "0")), "")
    all_terms = F.concat(F.lpad(F.hex(p["wide"][0]), 16, "0"), hexed(F.slice(p["wide"], 2, WIDE)))
    return F.when(p["terms"] > 0, F.concat(F.lpad(p["base"].cast("string"), 2, "0"), F.lit(":"), all_terms, F.lit(":"),
                                           hexed(p["near"]), hexed(p["far"]))
                  ).otherwise(F.concat(F.lit("w:"), F.hex(p["whole"])))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1, from two fingerprint structs (terms, base, near, far, wide, whole)."""
    same = (F.when(a["base"] == b["base"], F.zip_with(a["near"], b["near"], _match))
            .when(a["base"] + 1 == b["base"], F.zip_with(a["far"], b["near"], _match))
            .when(a["base"] == b["base"] + 1, F.zip_with(a["near"], b["far"], _match)))
    total = F.aggregate(same, F.lit(0), lambda s, x: s + x)
    every = (a["wide"][0] == b["wide"][0]).cast("int")
    wide = F.aggregate(F.zip_with(F.slice(a["wide"], 2, WIDE), F.slice(b["wide"], 2, WIDE),
                                  lambda p, q: (p == q).cast("int")), F.lit(0), lambda s, x: s + x)
    # null if the sizes are too far apart
    share = F.when(total.isNotNull(), F.greatest((F.floor(total / 1000) + every) / (total % 1000 + 1),
                                                 (wide + every) / F.lit(WIDE + 1.0)))
    plain = (a["whole"] == b["whole"]).cast("double")
    return F.when((a["terms"] == 0) | (b["terms"] == 0), plain).otherwise(F.coalesce(share, F.lit(0.0)))


def _match(p: Column, q: Column) -> Column:
    return F.when((p == 0) & (q == 0), F.lit(0)).when(p == q, F.lit(1001)).otherwise(F.lit(1))


def fingerprints(docs: DataFrame, lex: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, fingerprint."""
    rows = docs.select(F.monotonically_increasing_id().alias("block"), F.lit(0).alias("ord"), F.col(id_col).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return _prints(rows, lex, ["id"], ("t",)).select(F.col("id").alias(id_col), _text(F.col("p_t")).alias("fingerprint"))


def _as_longs(digest: Column) -> list[Column]:
    """A 64-digit hex text as four longs."""
    return [F.conv(F.substring(digest, 16 * i + 1, 16), 16, -10).cast("long").alias(f"sha{i}") for i in range(4)]


def compare_with_edits(docs: DataFrame, lex: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last third replaced by the start of the next document."""
    seq = with_next(docs, id_col, text_col)
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - third),
                      F.substring(F.coalesce("after", F.lit("")), F.lit(1), third))
    seq = seq.select("block", "ord", "id", "extra", F.length("text").cast("long").alias("n_chars"), F.col("text").alias("t"),
                     F.when(~F.col("extra"), edited).alias("e"))
    seq = seq.select("block", "ord", "id", "extra", "n_chars", *_as_longs(F.sha2("e", 256)), "t", "e")
    shas = [f"sha{i}" for i in range(4)]
    got = _prints(seq, lex, ["id", "extra", "n_chars", *shas], ("t", "e"))
    w = W.partitionBy("block").orderBy("ord")
    got = got.withColumn("next", F.lead("p_t").over(w)).where("not extra")
    sha = F.lower(F.concat(*(F.lpad(F.hex(x), 16, "0") for x in shas)))
    return got.select(
        F.col("id").alias(id_col), "n_chars", sha.alias("edited_sha256"), _text(F.col("p_t")).alias("fingerprint"),
        _text(F.col("p_e")).alias("edited_fingerprint"), likeness(F.col("p_t"), F.col("p_e")).alias("near_edited"),
        likeness(F.col("p_t"), F.col("next")).alias("near_next"))
