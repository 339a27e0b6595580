"""Cost of goods and parcel cost per day and brand (P14, SRC19, SRC20, JN11,
JN12, AG13).

Flow (all DataFrame code; per-row work is native regex and higher-order
functions, no Python UDF):

1. price list rows -> (row_no, price, pet, grp, ml, flav)               SRC19
2. order lines -> option rows per (day, brand, product, option) with the
   summed quantity, cancelled lines excluded, zero totals skipped.
3. distinct (brand, product, option) -> product group (JN12: the longest group
   inside the product name, found by grams and lengths), pieces
   parsed from the option text with ``transform``/``filter`` inside each row;
   group names leave the flavours by folding over the groups found in each
   distinct text, in list order.
4. piece -> unit cost: override, then price rows of the group (narrowed to
   the product's size when any matches) whose flavour contains the piece's
   flavour or is contained in it (JN11).  Prices are reduced to the best row
   per (group, size, flavour) and per (group, size, substring of a flavour)
   before they meet the distinct (group, size, flavour) lookups, so the join
   gives one row per key; the first non-PET row in list order wins, no hit ->
   rounded mean of the candidates.
5. collaboration brand: gift box, flavour + count tokens, flavour list in
   parentheses, pieces; its performance line has aliases and sizes of its own.
6. box cost, cans, pieces per option -> parcel rate (F19) -> summed per
   (day, brand) and rounded at the end (AG13).

Nothing is read back to the driver but whether a fold has ended; the plan does
not grow with the catalog.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martcraft.functions.classify import NOT_WORD_NEXT, WS, ship_rate, size_ml
from martcraft.functions.numeric import js_round
from martcraft.operators.containment import candidate_parts, word_index
from martcraft.session import materialize

WORD_NEXT = "(?=[A-Za-z0-9_])"

# Marketing labels removed from option text (case-insensitive).
OPTION_LABELS = ["추천구성", "실속구성", "실속세트", "최대할인", "무료배송", "맛보기팩", "입문팩",
                 "비밀특가", "비밀최저가", "최저가", "베스트", "구성", "세트", "할인", "배송", "맛보기",
                 "입문", "추천", "실속", "최대", "비밀", "특가", "단독", "최초", "시크릿", "벌크업",
                 "구매자한정", "한정", "선택", "개당", "행사", "사은품", "증정", "best", "new"]
# Price-list markers (PET bottle, excluded listings), the zero-sugar word.
PET_MARKER = "페트"
EXCLUDED_MARKERS = ["쉬링크", "신유통XO"]
ZERO_WORD = "제로"
PACK = "개입"


@dataclass(frozen=True)
class Override:
    group: str
    flavour: str
    price: float


@dataclass(frozen=True)
class CostConfig:
    """Business parameters of the cost engine (brand vocabulary lives here)."""
    malls: tuple[str, ...] = ("brand_a", "brand_b")
    collab_mall: str | None = "brand_b"            # brand priced by the collaboration list
    brand_prefixes: tuple[str, ...] = ()           # e.g. '<brand>_' stripped from names
    aliases: dict = field(default_factory=dict)    # flavour alias -> flavour
    overrides: tuple[Override, ...] = ()
    # collaboration-price engine
    collab_markers: tuple[str, ...] = ()           # price rows belonging to the collab list
    collab_energy: str = "energy"                  # first segment naming the base line
    collab_lines: tuple[tuple[str, str], ...] = () # (marker in 2nd segment, line name)
    collab_aliases: dict = field(default_factory=dict)
    collab_order_500: tuple[str, ...] = ()         # lines tried in order at 500 ml
    collab_line_250: str = "energy"                # line priced at 250 ml
    collab_tokens: tuple[str, ...] = ()            # flavours followed by a count, in match order
    perf_line: str | None = None                   # performance line: 500 ml, then 250 ml
    perf_products: tuple[str, ...] = ()            # markers in the product name
    perf_marker: str | None = None                 # marker before a token, or in a flavour
    perf_aliases: dict = field(default_factory=dict)
    gift_marker: str | None = None
    gift_cost: float = 0.0


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def js_trim(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def _rx(c: Column, pattern: str, repl: str = " ") -> Column:
    return F.regexp_replace(c, pattern, repl)


# ------------------------------------------------------------- SRC19/20
def parse_price_list(sheet: DataFrame, cfg: CostConfig) -> DataFrame:
    """SRC19: (row_no, name, price) -> (row_no, price, pet, grp, ml, flav)."""
    name = F.col("name").cast("string")
    price = F.col("price")
    excluded = name.rlike("|".join(EXCLUDED_MARKERS))
    t = _rx(name, r"^\[[^\]]*\]", "")
    for p in cfg.brand_prefixes:
        t = _rx(t, "^" + _quote(p), "")
    t = js_trim(_rx(t, f"^{PET_MARKER}{WS}*,?{WS}*", ""))
    segs = F.split(t, ",")
    seg0 = js_trim(F.element_at(segs, 1))
    seg1 = js_trim(F.coalesce(F.try_element_at(segs, F.lit(2)), F.lit("")))
    grp = _rx(_rx(seg0, r"\(.*?\)", ""), WS, "")
    flav = js_trim(_rx(_rx(_rx(seg1, r"\(.*?\)", ""), ZERO_WORD, ""), WS, ""))
    return (sheet.filter(price.isNotNull() & (price > 0) & name.isNotNull() & (name != "") & ~excluded)
            .select("row_no", price.cast("double").alias("price"),
                    name.contains(PET_MARKER).alias("pet"), grp.alias("grp"),
                    size_ml(t).alias("ml"), flav.alias("flav")))


def parse_collab_prices(sheet: DataFrame, cfg: CostConfig) -> DataFrame:
    """SRC20: collaboration price rows -> (line, flav, size, price); a later
    row of the same key wins; size defaults to 500."""
    name = F.col("name").cast("string")
    price = F.col("price")
    if not cfg.collab_markers:
        return sheet.sparkSession.createDataFrame([], "line string, flav string, size long, price double")
    marker = F.lit(False)
    for m in cfg.collab_markers:
        marker = marker | name.contains(m)
    t = _rx(name, r"^\[[^\]]*\]", "")
    for p in cfg.brand_prefixes:
        t = _rx(t, "^" + _quote(p), "")
    t = js_trim(t)
    segs = F.transform(F.split(t, ","), lambda x: js_trim(x))
    ml = F.regexp_extract(t, r"(?i)(\d+)\s*ml", 1)
    size = F.when(ml != "", ml.cast("bigint")).otherwise(F.lit(500).cast("bigint"))
    s1 = F.coalesce(F.try_element_at(segs, F.lit(2)), F.lit(""))
    line = None
    for needle, label in cfg.collab_lines:
        cond = s1.rlike(needle)
        line = F.when(cond, F.lit(label)) if line is None else line.when(cond, F.lit(label))
    line = s1 if line is None else line.otherwise(s1)
    line = F.when(F.element_at(segs, 1) == cfg.collab_energy, F.lit(cfg.collab_energy)).otherwise(line)
    n = F.size(segs)
    flav = _rx(_rx(F.coalesce(F.when(n > 1, F.try_element_at(segs, F.greatest(n - 1, F.lit(1)))), F.lit("")), ZERO_WORD, ""), WS, "")
    rows = (sheet.filter(price.isNotNull() & (price > 0) & name.isNotNull() & (name != "") & marker
                         & ~name.rlike("|".join(EXCLUDED_MARKERS)))
            .select("row_no", line.alias("line"), js_trim(flav).alias("flav"), size.alias("size"),
                    price.cast("double").alias("price")))
    return rows.groupBy("line", "flav", "size").agg(F.max_by("price", "row_no").alias("price"))


def _quote(s: str) -> str:
    return "\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E"


# ---------------------------------------------------------------- groups
def product_groups(prices: DataFrame, cfg: CostConfig) -> DataFrame:
    """(grp, ord): distinct groups; ord sorts longest first, ties in order of
    first appearance, override groups after the list's own."""
    own = prices.filter(F.col("grp") != "").groupBy("grp").agg(F.min("row_no").cast("long").alias("first"))
    names = list(dict.fromkeys(o.group for o in cfg.overrides if o.group))
    if names:
        late = prices.sparkSession.createDataFrame(
            [(g, (1 << 62) + i) for i, g in enumerate(names)], "grp string, first long")
        own = own.unionByName(late).groupBy("grp").agg(F.min("first").alias("first"))
    return own.select("grp", F.struct((-F.length("grp")).alias("len"), "first").alias("ord"))


def group_of(names: DataFrame, groups: DataFrame) -> DataFrame:
    """JN12: (pn) -> (pn, grp) of names that contain a group, whitespace aside."""
    bare = names.select("pn").distinct().withColumn("bare", _rx(F.col("pn"), WS, ""))
    inside = candidate_parts(bare, "bare", word_index(groups, "grp")).withColumnRenamed("part", "grp")
    best = inside.join(groups, "grp").groupBy("bare").agg(F.min_by("grp", "ord").alias("grp"))
    return bare.join(best, "bare").select("pn", "grp")


def without_groups(texts: DataFrame, groups: DataFrame) -> DataFrame:
    """(raw) -> (raw, fl): group names cut out one after the other in list order.

    Every round finds, for each text still open, the next group in order that
    the text (as it is by then) contains; each cut shortens the text, so the
    rounds are bounded by the groups inside one text."""
    live = texts.select("raw").distinct().select(
        "raw", F.col("raw").alias("fl"), F.lit(None).cast(groups.schema["ord"].dataType).alias("done"))
    index = materialize(word_index(groups, "grp"))
    out = None
    while True:
        found = candidate_parts(live, "fl", index).withColumnRenamed("part", "grp").join(groups, "grp")
        inside = live.join(found, "fl").select("raw", "done", "grp", "ord")
        nxt = (inside.filter(F.col("done").isNull() | (F.col("ord") > F.col("done")))
               .groupBy("raw").agg(F.min("ord").alias("ord"), F.min_by("grp", "ord").alias("grp")))
        step = materialize(live.join(nxt, "raw", "left"))
        ended = step.filter(F.col("grp").isNull()).select("raw", "fl")
        out = ended if out is None else out.unionByName(ended)
        live = step.filter(F.col("grp").isNotNull()).select(
            "raw", F.expr("replace(fl, grp, '')").alias("fl"), F.col("ord").alias("done"))
        if live.isEmpty():
            return out


# ---------------------------------------------------------- option grammar
# Option-text rewrite rules, applied in this order.  "WS" is the
# JavaScript whitespace class above; Java regex syntax.
OPTION_PRE_RULES = [
    (r"\[[^\]]*\]", " "),                                   # [tag]
    (f"\\({WS}*개당[^)]*\\)", " "),                            # (per-unit price)
    (f"\\({WS}*[+~][^)]*\\)", " "),                            # (+extra) (~range)
    (f"(?i)\\({WS}*[^)]*(?:원|%|off)[^)]*\\)", " "),            # (price / percent / off)
    (f"\\d[\\d,]*{WS}*원{WS}*[대!~]?", " "),                     # 12,000원
    (f"(?i)~?{WS}*\\d+{WS}*%{WS}*off", " "),                      # 10% off
    (f"맛{WS}*선택{WS}*[①②③④⑤⑥⑦⑧⑨0-9]*{WS}*[:：]?", "/"),          # "flavour choice N:" -> piece break
    (f"{PACK}{WS}*수{WS}*[:：]", " "),                              # "pack count:"
    ("[⭐️🔥✨]", " "),                                           # emoji
]
FLAVOUR_RULES = [
    (r"\([^)]*\)", " "),
    (r"[\[\]()*]", " "),
    ("[①②③④⑤⑥⑦⑧⑨]", " "),
    ("(?i)(" + "|".join(OPTION_LABELS) + ")", " "),
    (f"\\d+{WS}*{PACK}", " "),
    (PACK, " "),
    (f"(?i)\\d+\\.\\d+{WS}*(ml|l)?", " "),
    (f"(?i)\\d+{WS}*(?:(?:ml|l){NOT_WORD_NEXT}|종{WORD_NEXT})", " "),   # units at an ASCII word end
    (ZERO_WORD, ""),
    (r"[:：,·\-!?/]", " "),
    (r"\d+", " "),
]
PIECE_COUNT_PATTERNS = [f"\\((\\d+){WS}*{PACK}\\)", f"(\\d+){WS}*{PACK}", f"(\\d+){WS}*$",
                        r"\((\d+)\)", r"(\d+)"]


def _apply(c: Column, rules) -> Column:
    for pattern, repl in rules:
        c = _rx(c, pattern, repl)
    return c


def option_pre(on: Column) -> Column:
    return _apply(on, OPTION_PRE_RULES)


def clean_flavour(p: Column) -> Column:
    """Flavour text of a piece, group names still in it."""
    return _rx(js_trim(_apply(p, FLAVOUR_RULES)), f"{WS}+", "")


def piece_count(p: Column) -> Column:
    return F.coalesce(*[F.nullif(F.regexp_extract(p, q, 1), F.lit("")) for q in PIECE_COUNT_PATTERNS]) \
        .cast("bigint")


def raw_pieces(on: Column) -> Column:
    """Array of struct(raw, cnt) parsed from the option text (in order)."""
    parts = F.filter(F.transform(F.split(option_pre(on), "[/+]"), lambda x: js_trim(x)),
                     lambda x: x != "")
    return F.transform(parts, lambda p: F.struct(clean_flavour(p).alias("raw"), piece_count(p).alias("cnt")))


def pieces(options: DataFrame, groups: DataFrame) -> DataFrame:
    """(pkey_base, pn, on) -> (pkey_base, pos, fl, cnt): pieces with a flavour;
    a single one without a count takes the pack size of the product name."""
    raw = materialize(options.select("pkey_base", "pn", F.posexplode(raw_pieces(F.col("on"))).alias("pos", "p"))
                      .select("pkey_base", "pn", "pos", "p.raw", "p.cnt").filter(F.col("raw") != ""))
    named = raw.join(without_groups(raw, groups), "raw").filter(F.col("fl") != "")
    n = named.groupBy("pkey_base").agg(F.count(F.lit(1)).alias("n"))
    ip_name = F.nullif(F.regexp_extract("pn", f"(\\d+){WS}*{PACK}", 1), F.lit("")).cast("bigint")
    one = F.coalesce(F.nullif(ip_name, F.lit(0)), F.lit(1).cast("bigint"))
    return named.join(n, "pkey_base").select(
        "pkey_base", "pos", "fl",
        F.coalesce("cnt", F.when(F.col("n") == 1, one).otherwise(F.lit(1).cast("bigint"))).alias("cnt"))


def tokens(on: Column, cfg: CostConfig) -> Column:
    """Array of struct(fl, cnt): flavour + count tokens of the collaboration
    brand; the performance marker before a token becomes part of its flavour."""
    mark = f"(?:(\\Q{cfg.perf_marker}\\E){WS}*)?" if cfg.perf_marker else "()"
    rule = f"{mark}({'|'.join(_quote(t) for t in cfg.collab_tokens)}){WS}*\\(?{WS}*(\\d+)"
    at = [F.regexp_extract_all(on, F.lit(rule), F.lit(i)) for i in (1, 2, 3)]
    return F.transform(F.arrays_zip(*[a.alias(n) for a, n in zip(at, "mfc")]), lambda z: F.struct(
        F.concat(z["m"], z["f"]).alias("fl"), z["c"].cast("bigint").alias("cnt")))


# ------------------------------------------------------------ piece costs
ALL_SIZES = -1


def scoped(prices: DataFrame) -> DataFrame:
    """Every price row under its group as a whole and, if sized, under its size."""
    return prices.withColumn("scope", F.explode(F.array_compact(F.array(F.lit(ALL_SIZES).cast("long"),
                                                                        F.col("ml").cast("long")))))


def price_means(prices: DataFrame) -> DataFrame:
    """(grp, scope) -> mean price of the candidates."""
    return scoped(prices).groupBy("grp", "scope").agg(F.avg("price").alias("mean"))


def with_scope(rows: DataFrame, means: DataFrame) -> DataFrame:
    """rows (grp, psz) -> + scope (the size if the group lists it), mean (NULL without candidates)."""
    size = means.select("grp", F.col("scope").alias("psz"), F.col("mean").alias("m_mean"))
    whole = means.filter(F.col("scope") == ALL_SIZES).select("grp", F.col("mean").alias("g_mean"))
    return (rows.withColumn("psz", F.col("psz").cast("long")).join(size, ["grp", "psz"], "left")
            .join(whole, "grp", "left")
            .withColumn("scope", F.when(F.col("m_mean").isNotNull(), F.col("psz")).otherwise(F.lit(ALL_SIZES).cast("long")))
            .withColumn("mean", F.coalesce("m_mean", "g_mean")).drop("m_mean", "g_mean"))


def flavour_hits(lookups: DataFrame, prices: DataFrame) -> DataFrame:
    """JN11: (grp, scope, f) -> hit_price of the best row whose flavour contains f or lies in it."""
    best = F.min(F.struct("pet", "row_no", "price")).alias("best")
    listed = scoped(prices.filter(F.col("flav") != "")).groupBy("grp", "scope", "flav").agg(best)
    listed = materialize(listed)
    keys = materialize(lookups.filter(F.col("f") != "").select("grp", "scope", "f").distinct())
    within = ("grp", "scope")
    # parts of listed flavours that may be a looked-up one, reduced to the best row per part
    parts = (candidate_parts(listed, "flav", word_index(keys, "f", within), within).join(listed, [*within, "flav"])
             .groupBy(*within, F.col("part").alias("f")).agg(F.min("best").alias("best")))
    inside = (candidate_parts(keys, "f", word_index(listed, "flav", within), within).withColumnRenamed("part", "flav")
              .join(listed, [*within, "flav"]).select("grp", "scope", "f", "best"))
    around = keys.join(parts, ["grp", "scope", "f"])
    return (inside.unionByName(around).groupBy("grp", "scope", "f").agg(F.min("best").alias("best"))
            .select("grp", "scope", "f", F.col("best.price").alias("hit_price")))


def _alias(c: Column, aliases: dict) -> Column:
    if not aliases:
        return c
    return F.coalesce(F.create_map(*[x for k, v in aliases.items() for x in (F.lit(k), F.lit(v))])[c], c)


def piece_costs(piece_rows: DataFrame, prices: DataFrame, cfg: CostConfig) -> DataFrame:
    """piece rows (key cols + pos, fl, grp, psz, pns) -> + unit_cost."""
    p = piece_rows.withColumn("f", _alias(F.col("fl"), cfg.aliases))
    ov = F.lit(None).cast("double")
    for o in reversed(cfg.overrides):                 # the first that fits wins
        fits = (F.col("pns").contains(o.group) & (F.col("f") != "")
                & (F.col("f").contains(o.flavour) | F.lit(o.flavour).contains(F.col("f"))))
        ov = F.when(fits, F.lit(float(o.price))).otherwise(ov)
    p = with_scope(p.withColumn("ov_price", ov), price_means(prices))
    p = p.join(flavour_hits(p, prices), ["grp", "scope", "f"], "left")
    cost = (F.when(F.col("ov_price").isNotNull(), F.col("ov_price"))
             .when(F.col("mean").isNull(), F.lit(0.0))
             .when(F.col("hit_price").isNotNull(), F.col("hit_price"))
             .otherwise(js_round(F.col("mean")).cast("double")))
    return p.withColumn("unit_cost", cost)


def collab_costs(piece_rows: DataFrame, collab: DataFrame, cfg: CostConfig) -> DataFrame:
    """Unit cost of a collaboration-brand piece.  Performance line: its 500 ml
    price, else its 250 ml price.  Others: 250 ml products take the small line's
    250 ml price, the rest the first line in ``collab_order_500`` that lists the
    flavour at 500 ml; none -> 0."""
    perf = F.lit(False)
    if cfg.perf_line is not None:
        for m in cfg.perf_products:
            perf = perf | F.col("pn").contains(m)
        if cfg.perf_marker:
            perf = perf | F.col("fl").contains(cfg.perf_marker)
    p = piece_rows.withColumn("perf", perf).withColumn(
        "f", F.when(F.col("perf"), _alias(F.col("fl"), cfg.perf_aliases)).otherwise(_alias(F.col("fl"), cfg.collab_aliases)))
    p = p.withColumn("offer", F.when(F.col("perf"), F.lit("perf")).when(F.col("ctx").contains("250"), F.lit("250"))
                     .otherwise(F.lit("500")))
    offers = [("250", cfg.collab_line_250, 250, 0), *[("500", ln, 500, i) for i, ln in enumerate(cfg.collab_order_500)]]
    if cfg.perf_line is not None:
        offers += [("perf", cfg.perf_line, 500, 0), ("perf", cfg.perf_line, 250, 1)]
    offer = F.filter(F.array(*[F.struct(F.lit(o).alias("offer"), F.lit(ln).alias("line"), F.lit(sz).cast("bigint").alias("size"),
                                        F.lit(i).alias("pri")) for o, ln, sz, i in offers]),
                     lambda x: (x["line"] == F.col("line")) & (x["size"] == F.col("size")))
    c = (collab.select(F.col("flav").alias("f"), "price", F.explode(offer).alias("o"))
         .groupBy("f", F.col("o.offer").alias("offer")).agg(F.min_by("price", "o.pri").alias("c_price")))
    return p.join(c, ["f", "offer"], "left").withColumn("unit_cost", F.coalesce(F.col("c_price"), F.lit(0.0)))


# ------------------------------------------------------------------- P14
def option_rows(items: DataFrame, start: dt.date, end: dt.date, cfg: CostConfig) -> DataFrame:
    """Per (day, brand, product, option): summed quantity of non-cancelled
    lines in [start, end]; zero totals are skipped."""
    j = F.from_json("raw_json", "status_code string, option_value string")
    return (items.filter(F.col("mall").isin(*cfg.malls)
                         & F.col("report_date").between(F.lit(start), F.lit(end)))
            .select("report_date", "mall", "product_name", "quantity", j.alias("j"))
            .filter(~F.coalesce(F.col("j.status_code"), F.lit("")).like("C%"))
            .groupBy("report_date", "mall", "product_name", F.col("j.option_value").alias("option_value"))
            .agg(F.sum("quantity").alias("sale_count"))
            .filter(F.coalesce(F.col("sale_count"), F.lit(0)) != 0))


def box_costs(options: DataFrame, prices: DataFrame, collab: DataFrame | None,
              cfg: CostConfig) -> DataFrame:
    """Distinct (mall, pn, on) -> box_cost, cans, n_pieces (NULL = skipped)."""
    groups = materialize(product_groups(prices, cfg))
    combos = options.select("mall", F.coalesce(F.col("product_name"), F.lit("")).alias("pn"),
                            F.coalesce(F.col("option_value"), F.lit("")).alias("on")).distinct()
    combos = (combos.join(group_of(combos, groups), "pn")
              .withColumn("pkey_base", F.concat_ws("\u0001", "mall", "pn", "on"))
              .withColumn("pns", _rx(F.col("pn"), WS, ""))
              .withColumn("psz", F.nullif(size_ml(F.col("pn")), F.lit(0)))
              .withColumn("ctx", F.concat_ws(" ", "pn", "on"))
              .withColumn("sp", F.lit(cfg.collab_mall is not None) & (F.col("mall") == F.lit(cfg.collab_mall or ""))))
    # collaboration brand: gift box / flavour + count tokens / flavour list in parentheses
    par = F.regexp_extract(F.col("ctx"), r"\(([^)]*[가-힣][^)]*)\)", 1)
    par_ok = (par != "") & ~par.rlike(f"{PACK}|원|%")
    gift = F.lit(False) if not cfg.gift_marker else F.col("ctx").contains(cfg.gift_marker)
    toks = tokens(F.col("on"), cfg) if cfg.collab_tokens else F.array().cast("array<struct<fl:string,cnt:bigint>>")
    combos = materialize(
        combos.withColumn("gift", F.col("sp") & gift)
        .withColumn("toks", toks)
        .withColumn("tok", F.col("sp") & ~F.col("gift") & (F.size("toks") > 0))
        .withColumn("plist", F.col("sp") & ~F.col("gift") & ~F.col("tok") & par_ok)
        .withColumn("plist_flavs", F.filter(F.transform(F.split(par, "/"), lambda x: js_trim(x)), lambda x: x != ""))
        .withColumn("plist_ip", F.coalesce(
            F.nullif(F.regexp_extract(F.col("ctx"), f"(\\d+){WS}*{PACK}", 1), F.lit("")).cast("bigint"),
            F.lit(6).cast("bigint"))))
    # piece rows: regular pieces (both brands), tokens and listed flavours (collab brand)
    about = ["pkey_base", "grp", "pn", "pns", "psz", "ctx", "sp"]
    plain = combos.filter(~F.col("gift") & ~F.col("tok") & ~F.col("plist"))
    reg = plain.select(*about).join(pieces(plain, groups), "pkey_base").select(*about, "fl", "cnt")
    tok = combos.filter("tok").select(*about, F.explode("toks").alias("t")).select(*about, "t.fl", "t.cnt")
    lst = combos.filter("plist").select(*about, F.explode("plist_flavs").alias("fl"),
                                        F.lit(None).cast("bigint").alias("cnt"))
    pr = reg.unionByName(tok).unionByName(lst)
    priced = piece_costs(pr.filter(~F.col("sp")), prices, cfg).select("pkey_base", "cnt", "unit_cost")
    if collab is not None:
        priced = priced.unionByName(
            collab_costs(pr.filter(F.col("sp")), collab, cfg).select("pkey_base", "cnt", "unit_cost"))
    agg = priced.groupBy("pkey_base").agg(
        F.sum(F.coalesce(F.col("cnt"), F.lit(0)) * F.col("unit_cost")).alias("pc_box"),
        F.sum(F.coalesce(F.col("cnt"), F.lit(0))).alias("pc_cans"),
        F.count(F.lit(1)).alias("pc_n"),
        F.count_if(F.col("unit_cost") != 0).alias("nz_n"),
        F.sum("unit_cost").alias("cost_sum"))
    x = with_scope(combos.join(agg, "pkey_base", "left"), price_means(prices))
    # no-piece rule (regular brand): mean price x pack size
    ip = F.coalesce(
        F.nullif(F.regexp_extract(F.col("on"), f"(\\d+){WS}*{PACK}", 1), F.lit("")),
        F.nullif(F.regexp_extract(F.col("pn"), f"(\\d+){WS}*{PACK}", 1), F.lit("")),
        F.nullif(F.regexp_extract(F.col("on"), f"(\\d+){WS}*$", 1), F.lit(""))).cast("bigint")
    big_no_match = F.col("psz").isNotNull() & (F.col("scope") == ALL_SIZES) & (F.col("psz") >= 1000)
    per = js_round(F.col("mean"))
    nopiece_ok = ~F.coalesce(big_no_match, F.lit(False)) & F.col("mean").isNotNull() & (F.coalesce(ip, F.lit(0)) != 0)
    has_pieces = F.coalesce(F.col("pc_n"), F.lit(0)) > 0
    plist_mean = F.when(F.col("nz_n") > 0, F.col("cost_sum") / F.col("nz_n")).otherwise(F.lit(0.0))
    box = (F.when(F.col("gift"), F.lit(float(cfg.gift_cost)))
            .when(F.col("plist"), F.col("plist_ip") * plist_mean)
            .when(has_pieces, F.col("pc_box"))
            .when(~F.col("sp") & nopiece_ok, per * ip))
    cans = (F.when(F.col("gift"), F.lit(1))
             .when(F.col("plist"), F.col("plist_ip"))
             .when(has_pieces, F.col("pc_cans"))
             .when(~F.col("sp") & nopiece_ok, ip)).cast("bigint")
    npcs = (F.when(F.col("gift"), F.lit(1))
             .when(F.col("plist"), F.size("plist_flavs"))
             .when(has_pieces, F.col("pc_n"))
             .when(~F.col("sp") & nopiece_ok, F.lit(1))).cast("bigint")
    return x.select("mall", "pn", "on", box.cast("double").alias("box_cost"),
                    cans.alias("cans"), npcs.alias("n_pieces")).filter(F.col("box_cost").isNotNull())


def cost_daily(options: DataFrame, prices: DataFrame, collab: DataFrame | None,
               cfg: CostConfig) -> DataFrame:
    """P14 mart_cost_daily: (report_date, mall, cogs, ship)."""
    options = materialize(options)          # reused by every branch below
    boxes = box_costs(options, prices, collab, cfg)
    o = options.select("report_date", "mall",
                       F.coalesce(F.col("product_name"), F.lit("")).alias("pn"),
                       F.coalesce(F.col("option_value"), F.lit("")).alias("on"), "sale_count")
    x = o.join(boxes, ["mall", "pn", "on"])
    rate = ship_rate(F.col("cans"), F.col("n_pieces") > 1, F.col("pn"))
    return x.groupBy("report_date", "mall").agg(
        js_round(F.sum(F.col("sale_count") * F.col("box_cost"))).alias("cogs"),
        js_round(F.sum(F.col("sale_count") * rate)).alias("ship"))
