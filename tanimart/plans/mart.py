"""The gold mart: dimension scoped to the fact, and the analytical views.

Every view is a function of the fact (and the dimension) DataFrames, so it
can run on a freshly computed fact or on the written table alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tanimart import config
from tanimart.functions import text as tx


def referenced_ids(fact: DataFrame) -> DataFrame:
    """Distinct ids appearing as source or target in the fact (set UNION).

    One pass over the fact (both ids of a row exploded), then a distinct:
    the fact is read once, not once per side.
    """
    return (fact.select(F.explode(F.array("source_id", "target_id")).alias("mol_id"))
            .distinct())


#: Columns of the warehouse's dimension that the given tables have no data
#: for: always NULL, but there for a reader of the full schema.
UNFILLED = {"molecular_species": "string", "cx_logp": "decimal(9,2)", "full_mwt": "decimal(9,2)",
            "aromatic_rings": "int", "heavy_atoms": "int"}


def dimension(fact: DataFrame, molecules: DataFrame, properties: DataFrame) -> DataFrame:
    """One row per id referenced by the fact, with its attributes.

    ids LEFT JOIN dictionary LEFT JOIN properties.  The dictionary and
    properties are first cut down to the referenced ids by a semi join, so the
    per-row text work (word and line counts) runs only for the few rows that
    are kept; AQE broadcasts the ids when they are small at run time.
    """
    ids = referenced_ids(fact)
    dictionary = (molecules.join(ids, "mol_id", "left_semi")
                  .select("mol_id", "kind", "lang", "n_chars",
                          tx.word_count("text").alias("n_words"),
                          tx.line_count("text").alias("n_lines")))
    props = properties.join(ids, "mol_id", "left_semi")
    return (ids.join(dictionary, "mol_id", "left")
            .join(props, "mol_id", "left")
            .select("mol_id", "kind", "lang", "n_chars",
                    F.col("n_words").cast("int").alias("n_words"),
                    F.col("n_lines").cast("int").alias("n_lines"),
                    "quality", "toxic",
                    *[F.lit(None).cast(kind).alias(name) for name, kind in UNFILLED.items()]))


def _avg4(c) -> F.Column:
    return F.round(F.avg(c).cast("double"), 4)


def average_per_source(fact: DataFrame) -> DataFrame:
    """Average score per source, rounded to 4 places."""
    return fact.groupBy("source_id").agg(_avg4("score").alias("avg_score"))


def property_deviation(fact: DataFrame, dim: DataFrame, prop: str = "n_chars") -> DataFrame:
    """Per source: its property value and the mean |target - source| deviation."""
    s = dim.select(F.col("mol_id").alias("source_id"), F.col(prop).alias("source_value"))
    t = dim.select(F.col("mol_id").alias("target_id"), F.col(prop).alias("target_value"))
    joined = fact.join(s, "source_id").join(t, "target_id")
    return (joined.groupBy("source_id", "source_value")
            .agg(_avg4(F.abs(F.col("target_value") - F.col("source_value"))).alias("avg_deviation"))
            .select("source_id", F.col("source_value").alias(f"source_{prop}"),
                    F.col("avg_deviation").alias(f"avg_{prop}_deviation")))


def sampled_sources(fact: DataFrame, k: int = config.PIVOT_SOURCES) -> DataFrame:
    """A repeatable pick of ``k`` distinct sources: smallest md5(id) first.

    Returns (slot 1..k, source_id).  ``orderBy().limit(k)`` is a top-k (each
    task keeps k rows), so only k rows ever reach one task; the slots are
    their positions in one sorted array of those k rows.
    """
    picked = (fact.select("source_id").distinct()
              .orderBy(F.md5("source_id"), "source_id").limit(k))
    # Number the k picks by their position in one sorted array (k elements).
    ordered = picked.agg(F.sort_array(F.collect_list(
        F.struct(F.md5("source_id").alias("h"), F.col("source_id")))).alias("picks"))
    return ordered.select(F.posexplode("picks").alias("pos", "p")).select(
        (F.col("pos") + 1).cast("int").alias("slot"), F.col("p.source_id").alias("source_id"))


def pivot_sources(fact: DataFrame, k: int = config.PIVOT_SOURCES) -> DataFrame:
    """Rows = target, one column per sampled source slot, cell = score."""
    slots = sampled_sources(fact, k)
    names = {i: f"source_{i:02d}" for i in range(1, k + 1)}
    piv = (fact.join(F.broadcast(slots), "source_id")
           .groupBy("target_id").pivot("slot", list(names)).agg(F.max("score")))
    return piv.select("target_id", *[F.col(str(i)).alias(n) for i, n in names.items()])


def neighbor_chain(fact: DataFrame) -> DataFrame:
    """Each fact row with the next-ranked target and the source's 2nd target."""
    by_rank = Window.partitionBy("source_id").orderBy("rank")
    whole = Window.partitionBy("source_id")
    return fact.select(
        "source_id", "target_id", "score",
        F.lead("target_id").over(by_rank).alias("next_target_id"),
        F.max(F.when(F.col("rank") == 2, F.col("target_id"))).over(whole).alias("second_target_id"),
    )


def grouped_average(fact: DataFrame, dim: DataFrame,
                    pair: tuple[str, str] = ("n_lines", "n_words")) -> DataFrame:
    """Average score at four grains in one pass (GROUPING SETS).

    Grains: (source), (a, b), (b), ().  A rolled-up cell reads 'TOTAL'; a
    genuine NULL attribute stays NULL.
    """
    a, b = pair
    src = dim.select(F.col("mol_id").alias("source_id"), a, b)
    joined = fact.join(src, "source_id")
    sets = [[F.col("source_id")], [F.col(a), F.col(b)], [F.col(b)], []]
    agg = joined.groupingSets(sets, "source_id", a, b).agg(
        F.grouping("source_id").alias("_g_src"), F.grouping(a).alias("_g_a"),
        F.grouping(b).alias("_g_b"), _avg4("score").alias("avg_score"))

    def label(c: str, g: str) -> F.Column:
        return F.when(F.col(g) == 1, F.lit("TOTAL")).otherwise(F.col(c).cast("string")).alias(c)

    return agg.select(label("source_id", "_g_src"), label(a, "_g_a"), label(b, "_g_b"), "avg_score")
