"""Items that appear together: pair counts in baskets, lift and pointwise mutual information."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from octoseg.runtime import stage, table

#: The order of segments in a genotype profile.
SEGMENTS = ["PB2", "PB1", "PA", "HA", "NP", "NA", "M", "NS"]


def allele_items(profile: str | Column = "allele_profile") -> Column:
    """Allele names of a profile, upper case, without blanks, placeholders and repeats; null gives null."""
    parts = F.split(F.upper(F.regexp_replace(profile, r"(?U)\s+", "")), r"\|")
    return F.array_distinct(F.filter(parts, lambda x: ~x.isin("", "?", "-")))


def cluster_items(profile: str | Column = "genotype_profile") -> Column:
    """`SEG:Cn` by position of a dotted profile; placeholders and places beyond the eighth give no item."""
    parts = F.split(F.upper(F.regexp_replace(profile, r"(?U)\s+", "")), r"\.")
    names = F.array(*(F.lit(s) for s in SEGMENTS))
    pairs = F.transform(parts, lambda x, i: F.when(~x.isin("", "?", "-") & (i < len(SEGMENTS)), F.concat(F.get(names, i), F.lit(":"), x)))
    return F.array_distinct(F.filter(pairs, lambda x: x.isNotNull()))


def basket_items(df: DataFrame, basket: str, fields: dict[str, Column]) -> DataFrame:
    """Distinct (field, basket, item); a null basket or item is none. Repeated rows fall away before the shuffle."""

    def named(field: str, items: Column) -> Column:
        return F.transform(items, lambda x: F.struct(F.lit(field).alias("field"), x.alias("item")))

    each = [named(f, items) for f, items in fields.items()]
    all_items = F.flatten(F.array(*(F.coalesce(x, F.array().cast("array<struct<field:string,item:string>>")) for x in each)))
    rows = df.where(F.col(basket).isNotNull()).select(F.col(basket).alias("basket"), F.explode(all_items).alias("x"))
    return rows.select("x.field", "basket", "x.item").where("item is not null").distinct()


def pair_counts(items: DataFrame, min_support: int = 1, wide: int = 256) -> DataFrame:
    """(field, item_a, item_b, n_ab) with item_a < item_b over distinct (field, basket, item) rows.

    Items of fewer than min_support baskets are dropped first, as no pair of theirs can reach it; that is exact.
    Baskets of at most `wide` items emit their ordered pairs from one array, combined map-side. Wider ones are joined
    with themselves in splits of their items, so no basket is gathered in one task.
    """
    if min_support > 1:
        often = items.groupBy("field", "item").agg(F.count("*").alias("k")).where(F.col("k") >= min_support).select("field", "item")
        items = items.join(often, ["field", "item"], "left_semi")
    size = items.groupBy("field", "basket").agg(F.count("*").alias("size"))
    broad = stage(size.where(F.col("size") > wide), "wide")
    narrow = items
    extra = None
    if not broad.isEmpty():
        narrow = items.join(broad, ["field", "basket"], "left_anti")
        split = items.join(broad.select("field", "basket"), ["field", "basket"])
        parts = 16
        left = split.select("field", "basket", F.col("item").alias("item_a"), F.pmod(F.xxhash64("item"), F.lit(parts)).alias("pa"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("pb"))
        right = split.select("field", "basket", F.col("item").alias("item_b"), F.pmod(F.xxhash64("item"), F.lit(parts)).alias("pb"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("pa"))
        extra = left.join(right.withColumns({"pa": F.col("pa").cast("long"), "pb": F.col("pb").cast("long")}), ["field", "basket", "pa", "pb"]).where("item_a < item_b").select("field", "item_a", "item_b")
    sets = narrow.groupBy("field", "basket").agg(F.array_sort(F.collect_list("item")).alias("s")).where("size(s) > 1")
    rows = sets.select("field", F.explode(F.flatten(F.transform("s", lambda a, i: F.transform(F.slice(F.col("s"), i + 2, F.size("s")), lambda b: F.struct(a.alias("item_a"), b.alias("item_b")))))).alias("p"))
    rows = rows.select("field", "p.item_a", "p.item_b")
    if extra is not None:
        rows = rows.union(extra)
    return rows.groupBy("field", "item_a", "item_b").agg(F.count("*").alias("n_ab"))


def together(df: DataFrame, basket: str, fields: dict[str, Column], min_support: int = 1) -> DataFrame:
    """(field, item_a, item_b, n_ab, n_a, n_b, n, lift, pmi) for all pairs that share min_support baskets or more.

    n is the number of baskets with at least one item of the field; lift is n_ab n / (n_a n_b), pmi its logarithm
    to base 2. Null, empty and placeholder items count nowhere; an empty table gives no rows.
    """
    items = stage(basket_items(df, basket, fields), "items")
    n = items.groupBy("field").agg(F.countDistinct("basket").alias("n"))
    one = items.groupBy("field", "item").agg(F.count("*").alias("k"))
    pairs = pair_counts(items, min_support).where(F.col("n_ab") >= min_support)
    out = pairs.join(one.select("field", F.col("item").alias("item_a"), F.col("k").alias("n_a")), ["field", "item_a"])
    out = out.join(one.select("field", F.col("item").alias("item_b"), F.col("k").alias("n_b")), ["field", "item_b"]).join(n, "field")
    lift = F.col("n_ab").cast("double") * F.col("n") / (F.col("n_a").cast("double") * F.col("n_b"))
    return out.select("field", "item_a", "item_b", "n_ab", "n_a", "n_b", "n", lift.alias("lift"), F.log2(lift).alias("pmi"))



def genotype_pairs(genotypes: DataFrame, min_support: int = 1) -> DataFrame:
    """together() of the two profile columns of a genotypes table; the basket is the isolate."""
    return together(genotypes, "sequence_id", {"allele_profile": allele_items(), "genotype_profile": cluster_items()}, min_support)


def p1_pairs(spark, sf_dir: str) -> DataFrame:
    return genotype_pairs(table(spark, sf_dir, "genotypes")).withColumns({"lift": F.round("lift", 6), "pmi": F.round("pmi", 6)})


def p1_found(spark, sf_dir: str) -> DataFrame:
    """Pairs of 5 baskets or more that share six times as many as by chance; in whole numbers, so ties are exact."""
    p = genotype_pairs(table(spark, sf_dir, "genotypes"), 5)
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    return p.where(wide("n_ab") * wide("n") >= 6 * wide("n_a") * wide("n_b")).select("field", "item_a", "item_b")


_ITEMS_SQL = """
with items as (
  select distinct 'allele_profile' as field, sequence_id as basket, item
  from (select sequence_id, unnest(string_split(upper(regexp_replace(allele_profile, '\\s+', '', 'g')), '|')) as item from genotypes)
  where sequence_id is not null and item not in ('', '?', '-')
  union
  select distinct 'genotype_profile', sequence_id, seg || ':' || item
  from (select sequence_id, unnest(string_split(upper(regexp_replace(genotype_profile, '\\s+', '', 'g')), '.')[1:8]) as item,
               unnest(['PB2','PB1','PA','HA','NP','NA','M','NS']) as seg from genotypes where genotype_profile is not null)
  where sequence_id is not null and item not in ('', '?', '-')
),
n as (select field, count(distinct basket) as n from items group by field),
one as (select field, item, count(*) as k from items group by field, item),
ab as (select a.field, a.item as item_a, b.item as item_b, count(*) as n_ab from items a join items b
       on a.field = b.field and a.basket = b.basket and a.item < b.item group by all),
pairs as (select ab.field, ab.item_a, ab.item_b, n_ab, x.k as n_a, y.k as n_b, n.n from ab
          join one x on x.field = ab.field and x.item = item_a join one y on y.field = ab.field and y.item = item_b
          join n on n.field = ab.field)
"""
P1_SQL = {
    "p1_pairs": _ITEMS_SQL + "select *, round(n_ab::double * n / (n_a::double * n_b), 6) as lift, round(log2(n_ab::double * n / (n_a::double * n_b)), 6) as pmi from pairs",
    "p1_found": _ITEMS_SQL + "select field, item_a, item_b from pairs where n_ab >= 5 and n_ab::hugeint * n >= 6 * n_a::hugeint * n_b",
}
