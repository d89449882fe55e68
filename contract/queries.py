"""One Spark query per operator, model and card, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contract import derive as D
from contract.derive import LIMITS, PERIODS, load
from territory.functions import clean as C
from territory.operators import aggregate as A
from territory.operators import dedup, geo, incremental, joins, quality, rings, trend
from territory.operators.order_stats import exact_medians, value_ranks, percent_rank_of
from territory.operators.storage import checkpoint_folder, materialise
from territory.plans import mobility, serving, staging
from territory.plans.build import Models, build_models
from territory.sources import records, text
from territory import sinks
from territory import settings as S

Query = Callable[[SparkSession, str], DataFrame]

_models: dict[tuple[str, str], dict[str, DataFrame]] = {}
_tables: dict[tuple[str, str], serving.Tables] = {}


def models(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All models, each built once per session and input, when it is asked for;
    the stored ones play the part of the warehouse that the cards read."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _models:
        _models[key] = build_models(D.raw_tables(spark, sf_dir), LIMITS, tension=True)
    return _models[key]


def tables(spark: SparkSession, sf_dir: str) -> serving.Tables:
    """What the cards read, mobility tables stored too: a card pays for its own tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _tables:
        built = models(spark, sf_dir)
        steps = {
            "transit": lambda _: materialise(transit(spark, sf_dir)),
            "cycle": lambda _: materialise(cycle(spark, sf_dir)),
            **{name: lambda _, name=name: built[name] for name in built},
        }
        _tables[key] = serving.TablesOnDemand(Models(steps, list(steps)), PERIODS)
    return _tables[key]


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def single(df: DataFrame, *columns: str) -> DataFrame:
    """Means of doubles to single precision: the order of addition shows in the last digits
    of a double, and decimal rounding has ties where a mean of prices in cents lies."""
    return df.withColumns({c: F.col(c).cast("float").cast("double") for c in columns})


MEDIANS = ("prix_median", "prix_m2_median", "surface_mediane")
MEANS = ("prix_moyen", "prix_m2_moyen", "surface_moyenne")


# --- operators on the driver's tables ----------------------------------------


def nation_lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lots with price, area, kind, nation and year."""
    lots = load(spark, sf_dir, "lineitem").filter(
        C.is_one_of("l_returnflag", ("A", "R")) & C.strictly_between("l_quantity", 5, 5000)
    )
    orders = load(spark, sf_dir, "orders").filter(C.strictly_between("o_totalprice", 1000, 50_000_000))
    people = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return lots.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        people, F.col("o_custkey") == F.col("c_custkey")
    ).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag",
        "o_totalprice", F.col("c_nationkey").alias("nation"), C.year_of("o_orderdate").alias("annee"),
    )


LOT_TIES = ("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")


def nation_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = dedup.keep_largest(nation_lots(spark, sf_dir), "l_orderkey", "l_quantity", LOT_TIES)
    kinds = {"nb_ventes_a": "A", "nb_ventes_r": "R"}
    return A.price_stats(
        sales, ["nation", "annee"], "o_totalprice", "l_quantity", "l_returnflag", kinds
    )


def price_stats_nation_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return single(rounded(nation_prices(spark, sf_dir), 6, *MEDIANS), *MEANS)


def price_evolution_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = nation_prices(spark, sf_dir).filter(F.col("nb_ventes") >= 5)
    series = trend.with_previous(
        kept, "nation", "annee", {"prix_m2_median": "prix_m2_prec", "prix_median": "prix_prec"}
    )
    return series.select(
        "nation", "annee", "nb_ventes",
        F.round("prix_m2_median", 6).alias("prix_m2_median"), "prix_median",
        F.round("prix_m2_prec", 6).alias("prix_m2_prec"), "prix_prec",
        C.pct_change("prix_m2_median", "prix_m2_prec").alias("variation_m2"),
        C.pct_change("prix_median", "prix_prec").alias("variation"),
    )


def cumulative_change_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = nation_prices(spark, sf_dir).filter(F.col("nb_ventes") >= 5)
    return trend.cumulative_change(kept, "nation", "annee", "prix_median", "cumul").select(
        "nation", "annee", "prix_median", "cumul"
    )


def keep_largest_lot(spark: SparkSession, sf_dir: str) -> DataFrame:
    lots = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", "l_extendedprice", *LOT_TIES
    )
    return dedup.keep_largest(lots, "l_orderkey", "l_quantity", (*LOT_TIES, "l_extendedprice"))


def exact_medians_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few, large groups."""
    orders = load(spark, sf_dir, "orders")
    stats = exact_medians(
        orders, ["o_orderpriority"],
        {"price": F.col("o_totalprice"), "month": F.month("o_orderdate")},
    )
    return stats.select(
        "o_orderpriority", "price_count", "price_median", F.col("price_mean").cast("float").cast("double").alias("price_mean"),
        F.round("price_sum", 2).alias("price_sum"), "month_median",
    )


def percent_rank_of_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = value_ranks(
        load(spark, sf_dir, "customer"), ["c_mktsegment"], {"balance": F.col("c_acctbal")}
    )
    return ranks.select(
        "key.c_mktsegment", F.col("value").alias("c_acctbal"), "n",
        F.round(percent_rank_of(), 9).alias("pr"),
    )


def clean_numeric_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    token = (
        F.when(key % 7 == 0, "").when(key % 7 == 1, " s ").when(key % 7 == 2, "nd")
        .when(key % 7 == 3, "NA").otherwise(F.concat(F.lit(" "), D.comma(F.col("o_totalprice"))))
    )
    rooms = F.when(key % 5 == 0, "  ").otherwise(F.concat(D.text(key % 9), F.lit(".4")))
    rows = load(spark, sf_dir, "orders").select("o_orderkey", token.alias("t"), rooms.alias("r"))
    return rows.select(
        "o_orderkey", C.clean_string("t").alias("trimmed"), C.clean_numeric("t").alias("number"),
        C.blank_to_null("r").alias("filled"), C.blank_to_null_cast("r", "int").alias("rooms"),
        C.is_filled("r").alias("has_rooms"),
        F.round(C.safe_divide(C.clean_numeric("t"), key % 4), 4).alias("ratio"),
    )


def code_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix, department, perimeter and region predicates on commune codes."""
    return D.customers(spark, sf_dir).select(
        "c_custkey", "code",
        C.department_of("code").alias("department"), C.district_number("code").alias("district"),
        C.district_code(F.col("c_custkey") % 20 + 1).alias("district_code"),
        C.in_city("code").alias("in_city"), C.in_departments("dep").alias("in_departments"),
        C.in_inner_ring(True, code="code").alias("ring_with_city"),
        C.in_inner_ring(False, department="dep").alias("ring"),
        C.in_region(F.when(F.col("dep") != "95", F.when(F.col("dep") == "60", "32").otherwise("11"))).alias("in_region"),
    )


def rounding_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("p_retailprice")
    return load(spark, sf_dir, "part").select(
        "p_partkey", F.round(price / 8, 1).alias("tenth"), F.round(price / 8, 2).alias("hundredth"),
        C.round_half_even(F.col("p_size") / 2).alias("half_even"),
        F.round(F.col("p_size") / 2).alias("half_up"), C.complement_rate(price / 16).alias("complement"),
    )


def age_structure_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part").withColumn(
        "age", F.when(F.col("p_partkey") % 13 != 0, F.col("p_size") * 3 - 10)
    ).withColumn("band", C.age_band("age")).withColumn("amount", F.col("p_size") + F.lit(0.5))
    return A.detail_with_totals(part, "p_brand", "band", "amount").withColumn(
        "share", C.share("amount", "total")
    )


def age_group_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part").withColumn("band", C.age_band(F.col("p_size") * 2 - 5)).withColumn(
        "amount", F.col("p_retailprice")
    )
    band = F.col("band")
    groups = {
        "15_24": band.isin("15-19", "20-24"), "25_39": band.isin("25-29", "30-34", "35-39"),
        "40_59": band.isin("40-44", "45-49", "50-54", "55-59"), "60_plus": (band >= "60-64") & (band <= "95+"),
    }
    return rounded(
        A.shares_of_total(part, "p_brand", "amount", groups), 2, "total", *[f"pop_{g}" for g in groups]
    )


def rate_per_thousand_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select(
        "user_id", F.dayofmonth("ts").alias("day"), "value",
        F.when(F.col("user_id") % 10 != 0, F.col("user_id") * 3).otherwise(0).cast("double").alias("people"),
    )
    return rounded(A.rate_per_thousand(events, ["user_id", "day"], "value", "people"), 2, "facts")


def category_rate_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    offence = F.create_map(*[F.lit(v) for pair in D.OFFENCES.items() for v in pair])
    events = load(spark, sf_dir, "events").select(
        C.crime_category(offence[F.col("event_type")]).alias("category"),
        F.dayofmonth("ts").alias("day"), "value", (F.col("user_id") + 100).cast("double").alias("people"),
    )
    return events.groupBy("day", "category").agg(A.rate_on_sums("value", "people").alias("rate"))


def star_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left star joins; the last filter makes one of them an inner join."""
    nation = load(spark, sf_dir, "nation").withColumnsRenamed({"n_nationkey": "nation", "n_regionkey": "region"})
    region = load(spark, sf_dir, "region").filter("r_regionkey <> 3").withColumnsRenamed({"r_regionkey": "region"})
    supply = load(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(
        F.max("s_acctbal").alias("best_supplier")
    ).filter("best_supplier > 5000")
    people = load(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "nation")
    base = joins.enrich(people, [nation, supply], "nation")
    return joins.enrich(base, [region], "region").filter("best_supplier is not null").select(
        "c_custkey", "nation", "n_name", "region", "r_name", "best_supplier"
    )


def region_restriction(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = load(spark, sf_dir, "nation").filter("n_regionkey in (1, 2)").select(
        F.col("n_nationkey").alias("c_nationkey")
    )
    return joins.restrict_to(load(spark, sf_dir, "customer"), nation, "c_nationkey").select(
        "c_custkey", "c_nationkey"
    )


def latest_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select(
        "event_id", F.to_date("ts").alias("day"), F.when(F.col("event_type") == "error", F.col("value")).alias("v")
    )
    return joins.latest_only(events, "day", F.col("v").isNotNull()).select("event_id", "v")


def top_k_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    counts = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    chosen = joins.top_k(counts, "n", 10, ["o_custkey"])
    return joins.members_of(orders, chosen, "o_custkey").select("o_custkey", "o_orderkey", "o_totalprice")


def lookup_last_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last order per customer; customers whose last order has no price kept out."""
    orders = load(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
    )
    people = load(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return joins.lookup_last(people, orders, "c_custkey", F.col("o_orderkey"), "price")


def having_small_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").filter("o_totalprice > 10000")
    keys = {"o_custkey": F.col("o_custkey"), "annee": C.year_of("o_orderdate")}
    rows = orders.select(*[c.alias(k) for k, c in keys.items()], "o_totalprice")
    stats = exact_medians(rows, list(keys), {"price": F.col("o_totalprice")}, sums=False)
    return stats.filter("price_count >= 5").select(
        *keys, F.col("price_count").alias("nb"), F.round("price_median").alias("prix_median")
    )


def distinct_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "events").select(
        "user_id", "event_type", F.to_date("ts").alias("day")
    ).dropDuplicates()
    return A.distinct_by(rows, ["user_id"], {"types": "event_type", "days": "day"})


def zone_weighted_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted means whose values may be missing while their weight counts."""
    rows = load(spark, sf_dir, "customer").select(
        "c_nationkey", F.when(F.col("c_custkey") % 6 != 0, F.col("c_acctbal")).alias("v"),
        (F.col("c_custkey") % 17).cast("double").alias("w"),
    )
    return A.weighted_rollup(
        rows, ["c_nationkey"], {"mean_1": ("v", "w", 1), "mean_4": ("v", "w", 4)},
        F.count(F.lit(1)).alias("n"), C.total("w").alias("w"),
    )


def education_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of part types by brand, in per cent."""
    counts = load(spark, sf_dir, "part").groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count(F.when(F.col("p_type") == t, 1)).alias(t) for t in ("ECONOMY", "SMALL", "PROMO", "MEDIUM")],
    )
    raw = counts.select(
        F.col("p_brand").alias("CODGEO"), D.text("total").alias("P21_NSCOL15P"),
        D.text("ECONOMY").alias("P21_NSCOL15P_DIPLMIN"), D.text("SMALL").alias("P21_NSCOL15P_SUP2"),
        D.text("PROMO").alias("P21_NSCOL15P_SUP34"), D.text("MEDIUM").alias("P21_NSCOL15P_SUP5"),
    )
    return staging.diplomas(raw)


def incremental_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders before 2000 are stored; all orders come in, with one more
    column, and every fourth late one under the key of an old one."""
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"), "o_totalprice"
    )
    stored = orders.filter("day < date'2000-01-01'")
    late = F.col("day") >= F.lit("2000-01-01").cast("date")
    moved = F.when(late & (F.col("o_orderkey") % 4 == 0), F.floor(F.col("o_orderkey") / 2)).otherwise(F.col("o_orderkey"))
    incoming = orders.select(
        moved.alias("o_orderkey"), "day", "o_totalprice", D.text("o_orderkey").alias("source")
    )
    return incremental.incremental_load(stored, incoming, "day", "o_orderkey")


def union_orders_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    first = orders.filter("o_orderstatus = 'O'").select("o_orderkey", "o_totalprice", "o_orderstatus")
    second = orders.filter("o_orderstatus <> 'O'").select("o_custkey", "o_orderkey")
    return text.union_by_name([first, second])


# --- sources and sinks: whole tables written and read back --------------------


def scratch(spark: SparkSession, sf_dir: str, name: str) -> str:
    size = sf_dir.rstrip("/").rsplit("/", 1)[-1]
    application = spark.sparkContext.applicationId
    return f"{checkpoint_folder(spark)}/tables/{application}/{size}/{name}"


def csv_gzip_latin1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Semicolon text in a legacy encoding, gzip; read back as text."""
    path = scratch(spark, sf_dir, "latin1")
    rows = load(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("Clé "), F.col("c_name")).alias("nom"),
        D.comma(F.col("c_acctbal")).alias("solde"),
    )
    rows.write.mode("overwrite").options(
        header=True, sep=";", encoding="ISO-8859-1", compression="gzip"
    ).csv(path)
    back = text.read_text_table(spark, path, sep=";", encoding="ISO-8859-1")
    return back.select(
        C.blank_to_null_cast("c_custkey", "bigint").alias("c_custkey"), "nom",
        C.clean_numeric("solde").alias("solde"),
    )


def csv_many_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders with the columns in another order and one column missing."""
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"
    )
    one, two = scratch(spark, sf_dir, "headers_1"), scratch(spark, sf_dir, "headers_2")
    orders.filter("o_orderstatus = 'O'").write.mode("overwrite").option("header", True).csv(one)
    orders.filter("o_orderstatus <> 'O'").select(
        "o_orderstatus", "o_orderkey", "o_totalprice"
    ).write.mode("overwrite").option("header", True).csv(two)
    files = [f for path in (one, two) for f in spark.read.text(path).inputFiles()]
    back = text.read_many_by_name(spark, files)
    return back.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        F.col("o_totalprice").cast("double").alias("o_totalprice"), "o_orderstatus", "o_orderpriority",
    )


def csv_many_headers_latin1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gzip files in a legacy encoding, with accents in differing headers."""
    people = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("clé"), F.col("c_name").alias("libellé"), "c_nationkey")
    one, two = scratch(spark, sf_dir, "latin_headers_1"), scratch(spark, sf_dir, "latin_headers_2")
    for path, frame in ((one, people.drop("c_nationkey")), (two, people.select("c_nationkey", "clé"))):
        frame.write.mode("overwrite").options(header=True, sep=";", encoding="ISO-8859-1", compression="gzip").csv(path)
    files = [f for path in (one, two) for f in spark.read.text(path).inputFiles()]
    back = text.read_many_by_name(spark, files, sep=";", encoding="ISO-8859-1", spread=text.spread_of(spark, files))
    return back.select(F.col("clé").cast("bigint").alias("k"), F.col("libellé").alias("name"), F.col("c_nationkey").cast("int").alias("nation"))


def csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, sf_dir, "typed")
    part = load(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    part.write.mode("overwrite").options(header=True, sep=";").csv(path)
    return text.read_typed_csv(spark, path, part.schema)


def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, sf_dir, "export")
    sinks.export_csv(models(spark, sf_dir)["accessibility"].select("code_commune", "annee", "prix_median", "loyer_m2_median"), path)
    back = text.read_text_table(spark, path)
    return back.select(
        "code_commune", F.col("annee").cast("int").alias("annee"),
        F.col("prix_median").cast("double").alias("prix_median"),
        F.col("loyer_m2_median").cast("double").alias("loyer_m2_median"),
    )


def serving_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result tables published; rows stored per table."""
    m = models(spark, sf_dir)
    chosen = {name: m[name] for name in ("accessibility", "zones", "evolution", "crime_detail")}
    return sinks.publish(chosen, scratch(spark, sf_dir, "serving"))


def versioned_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of a stored table: first load, then the later rows."""
    root = scratch(spark, sf_dir, "versions")
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"), "o_totalprice"
    )
    incremental.load_version(spark, root, orders.filter("day < date'1999-06-01'"), "day", "o_orderkey", 1)
    later = orders.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return incremental.load_version(spark, root, later, "day", "o_orderkey", 2)


def keyed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads: most orders, later ones, then new days that replace some old keys; only files that can hold one are opened."""
    root = scratch(spark, sf_dir, "keyed")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), "o_totalprice")
    incremental.load_version(spark, root, orders.filter("day < date'1997-01-01'"), "day", "o_orderkey", 1)
    incremental.load_version(spark, root, orders.filter("day >= date'1997-01-01'"), "day", "o_orderkey", 2)
    again = orders.filter("o_orderkey % 100 = 7").withColumns({"day": F.date_add("day", 10_000), "o_totalprice": F.col("o_totalprice") * 2})
    return incremental.load_version(spark, root, again, "day", "o_orderkey", 3)


def csv_sniffed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables with four separators, their text quoted and full of the others; read without naming one."""
    frames = []
    customers = load(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("a,b;c\t|"), F.col("c_name"), F.lit(";,|")).alias("label"), "c_nationkey"
    )
    for n, sep in enumerate(text.SEPARATORS):
        path = scratch(spark, sf_dir, f"sniffed_{n}")
        customers.write.mode("overwrite").options(header=True, sep=sep, quoteAll=True, escape='"').csv(path)
        back = text.read_text_table(spark, path, sep=None)
        frames.append(back.select(F.lit(n).alias("kind"), F.col("c_custkey").cast("bigint").alias("c_custkey"), "label", F.col("c_nationkey").cast("int").alias("c_nationkey")))
    return text.union_by_name(frames)


def geojson_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas written as one feature per line, read back, measured."""
    path = scratch(spark, sf_dir, "features")
    shape = F.struct(F.lit("Polygon").alias("type"), F.col("geom")[0].alias("coordinates"))
    D.areas(spark, sf_dir).select(
        F.lit("Feature").alias("type"), F.struct("code", "nom").alias("properties"), shape.alias("geometry")
    ).write.mode("overwrite").json(path)
    back = records.read_geojson(spark, path, lines=True)
    return back.select("code", "nom", geo.planar_area(F.col("geom")).alias("area"))


def _zones_read_back(spark: SparkSession, sf_dir: str, documents: bool) -> DataFrame:
    """Zone files of either form written and read back: every feature with its size and a corner."""
    path = scratch(spark, sf_dir, "zone_documents" if documents else "zone_lines")
    sinks.write_geojson_by_zone(D.areas(spark, sf_dir), path, documents=documents)
    frames = [
        records.read_geojson(spark, f"{path}/zone={zone}", lines=not documents).select(
            F.lit(zone).alias("zone"), "code", "nom", F.round(geo.planar_area(F.col("geom")), 6).alias("area"),
            F.col("geom")[0][0][0][0].alias("x"), F.col("geom")[0][0][0][1].alias("y"),
        )
        for zone in sinks.zone_files()
        if text.path_exists(spark, f"{path}/zone={zone}")
    ]
    return text.union_by_name(frames)


def geojson_zone_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zones_read_back(spark, sf_dir, documents=True)


def geojson_zone_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zones_read_back(spark, sf_dir, documents=False)


def raw_full_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table replaced as a whole by other rows: no old key is left."""
    name = "raw_orders_" + sf_dir.rstrip("/").rsplit("/", 1)[-1].replace(".", "_").replace("-", "_")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    sinks.replace_table(orders, name)
    other = orders.select((-1 - F.col("o_orderkey")).alias("o_orderkey"), (F.col("o_totalprice") + 1).alias("o_totalprice"))
    return sinks.replace_table(other, name, bucket_by="o_orderkey", buckets=8)


def view_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    sinks.as_view(load(spark, sf_dir, "orders").filter("o_orderstatus = 'F'"), "finished_orders")
    return spark.sql("select o_orderkey, o_totalprice from finished_orders")


def table_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stored by status, read back one status: other folders are not touched."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    stored = sinks.write_parquet(orders, scratch(spark, sf_dir, "table_layer"), by="o_orderstatus")
    return stored.filter("o_orderstatus = 'F'")


def csv_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that lack their last field, in gzip files: padded with nulls, or skipped."""
    path = scratch(spark, sf_dir, "ragged")
    line = F.concat_ws(";", D.text("p_partkey"), "p_brand", F.when(F.col("p_partkey") % 5 != 0, D.text("p_size")))
    file = F.floor(F.col("p_partkey") / 5000).alias("file")
    part = load(spark, sf_dir, "part").select(file, F.lit(1).alias("o"), line.alias("value"))
    header = part.select("file", F.lit(0).alias("o"), F.lit("p_partkey;p_brand;p_size").alias("value")).distinct()
    # Files with their header first, as such archives come; as many as there are ranges of keys.
    rows = header.union(part).repartition("file").sortWithinPartitions("file", "o")
    rows.select("file", "value").write.mode("overwrite").partitionBy("file").text(path, compression="gzip")
    frames = [
        text.read_text_table(spark, path, sep=";", skip_malformed=skip, spread=8).select(
            F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_brand",
            F.col("p_size").cast("int").alias("p_size"), F.lit(mode).alias("mode"),
        )
        for mode, skip in (("padded", False), ("skipped", True))
    ]
    return text.union_by_name(frames)


def _pages(df: DataFrame, path: str, root: str, record: Column, order: str, width: int) -> None:
    """Records as JSON documents of a listing in pages of ``width`` keys, in order."""
    numbered = df.select(F.floor(F.col(order) / width).alias("page"), F.struct(order, record.alias("r")).alias("s"))
    body = F.transform(F.array_sort(F.collect_list("s")), lambda s: s["r"])
    document = F.struct(body.alias(root.split(".")[-1]))
    for name in reversed(root.split(".")[:-1]):
        document = F.struct(document.alias(name))
    rows = numbered.groupBy("page").agg(F.to_json(document).alias("value"))
    # A document is a file, as such listings come; names ascend with the pages.
    paged = rows.select(F.lpad(F.col("page").cast("string"), 12, "0").alias("p"), "value")
    paged.write.mode("overwrite").partitionBy("p").text(path)


def records_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, sf_dir, "stations")
    people = load(spark, sf_dir, "customer").withColumn("name", F.col("c_name"))
    record = F.struct(
        F.when(F.col("c_custkey") % 3 != 0, D.text("c_custkey")).alias("stationCode"),
        F.col("c_custkey").alias("station_id"), "name", F.lit(2.5).alias("lat"), F.lit(48.5).alias("lon"),
        (F.col("c_custkey") % 40).cast("int").alias("capacity"),
    )
    _pages(people, path, "data.stations", record, "c_custkey", 500)
    return records.read_stations(spark, path)


def records_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two listings in a stated order."""
    one, two = scratch(spark, sf_dir, "stops_1"), scratch(spark, sf_dir, "stops_2")
    first = F.struct(
        F.col("s_name").alias("stop_name"), D.text("s_suppkey").alias("stop_lat"), F.lit("48").alias("stop_lon"),
        F.lit("Metro").alias("mode"), F.concat(F.lit("M"), D.text(F.col("s_suppkey") % 14)).alias("shortname"),
    )
    _pages(load(spark, sf_dir, "supplier"), one, "results", first, "s_suppkey", 50)
    second = F.struct(
        F.col("n_name").alias("stop_name"), D.text("n_nationkey").alias("stop_lat"), F.lit("48").alias("stop_lon"),
        F.lit("RER").alias("mode"), F.concat(F.lit("R"), D.text("n_regionkey")).alias("shortname"),
    )
    _pages(load(spark, sf_dir, "nation"), two, "results", second, "n_nationkey", 50)
    stops = records.read_stops(spark, [one, two])
    return stops.select("seq.source", "stop_name", "lat", "line")


def records_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions in several pages: of a counter's records the last one holds, in the order of pages and places."""
    path = scratch(spark, sf_dir, "counters")
    record = F.struct(
        D.text(F.col("s_suppkey") % 50).alias("id_compteur"),
        F.struct(F.col("s_suppkey").cast("double").alias("lat"), F.lit(2.0).alias("lon")).alias("coordinates"),
    )
    _pages(load(spark, sf_dir, "supplier"), path, "results", record, "s_suppkey", 40)
    counters = records.read_counters(spark, path)
    return counters.groupBy("id_compteur").agg(F.max_by("lat", "seq").alias("lat"))


def optional_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw table that is there, and one that is not: no rows, the same columns."""
    path = scratch(spark, sf_dir, "optional")
    part = load(spark, sf_dir, "part").select(D.text("p_partkey").alias("CODGEO"))
    part.write.mode("overwrite").options(header=True, sep=";").csv(path)
    present = text.read_raw(spark, "income", path)
    absent = text.read_raw(spark, "income", f"{path}-nowhere", f"{path}-nowhere.gz")
    counts = [df.agg(F.lit(state).alias("state"), F.count("CODGEO").alias("n")) for state, df in (("present", present), ("absent", absent))]
    return text.union_by_name(counts)


def sales_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored sales up to a day; later ones come in, every fourth under the id of an old sale, and a late date is ignored."""
    raw = D.RAW["sales"](spark, sf_dir)
    stored = staging.clean_sales(raw).filter("date_mutation <= date'1999-12-31'")
    number = F.expr("cast(substr(trim(id_mutation), 2) as bigint)")
    late = C.parse_date("date_mutation") > F.lit("1999-12-31").cast("date")
    moved = F.when(late & (number % 4 == 0), F.concat(F.lit("M"), F.floor(number / 2).cast("string")))
    incoming = raw.withColumn("id_mutation", F.coalesce(moved, "id_mutation"))
    return staging.load_sales(stored, incoming).select("id_mutation", "numero_disposition", "date_mutation", "valeur_fonciere")


# --- geography ----------------------------------------------------------------


def points_in_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = mobility.tag_points(D.stations(spark, sf_dir), D.areas(spark, sf_dir))
    return tagged.select("name", "lat", "lon", "capacity", "code_commune", "nom_commune")


def area_km2(spark: SparkSession, sf_dir: str) -> DataFrame:
    areas = mobility.commune_areas(D.areas(spark, sf_dir))
    return areas.select("code_commune", F.round("area_km2", 6).alias("area_km2"))


def bike_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mobility.bike_density(D.stations(spark, sf_dir), D.areas(spark, sf_dir))


def station_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mobility.station_lines(D.stops(spark, sf_dir))


def transit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mobility.transit_density(D.stops(spark, sf_dir), D.areas(spark, sf_dir))


def cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mobility.cycle_density(D.cycle_paths(spark, sf_dir), D.areas(spark, sf_dir))


def located_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mobility.located_counters(
        D.counter_counts(spark, sf_dir), D.counter_positions(spark, sf_dir), F.col("seq"),
        "1998-03-01", "1998-04-01",
    )


def _grid_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit squares on a lattice five wide, one per supplier, by region."""
    key = F.col("s_suppkey")
    x, y = (key % 5).cast("double"), F.floor(key / 5).cast("double")
    corners = ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))
    ring = F.array(*[F.array(x + dx, y + dy) for dx, dy in corners])
    return load(spark, sf_dir, "supplier").select(
        (key % 3).alias("region"), F.array(F.array(ring)).alias("geom")
    )


def dissolve_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.dissolve_boundary(_grid_squares(spark, sf_dir), "region")


def points_in_large_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A polygon of up to 8192 corners per block of orders, and a point per line of them."""
    orders = load(spark, sf_dir, "orders")
    key, block = F.col("o_orderkey"), F.floor(F.col("o_orderkey") / 8192)
    height = F.floor(F.col("o_totalprice") % 997) / 8 + 1
    corner = F.struct((key % 8192).cast("double").alias("x"), (height + block * 256).alias("y"))
    chains = orders.groupBy(block.alias("block")).agg(F.array_sort(F.collect_list(corner)).alias("top"))
    base = (F.col("block") * 256).cast("double")
    top = F.transform("top", lambda p: F.array(p.x, p.y))
    ends = F.array(F.array(F.element_at("top", -1).x, base), F.array(F.get("top", F.lit(0)).x, base), F.element_at(top, 1))
    areas = chains.select("block", F.array(F.array(F.concat(top, ends))).alias("geom"))
    row = F.floor(F.col("l_orderkey") / 8192)
    points = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_orderkey") % 8192 + 0.5).alias("x"),
        (row * 256 + F.floor(F.col("l_extendedprice") % 1009) / 8 + 0.0137).alias("y"),
    )
    found = geo.points_in_polygons(points, areas, "x", "y", ["block"])
    return found.select("l_orderkey", "l_linenumber", "block")


def department_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlines of regions of bricks, a brick per customer in credit: their size, length, parts less holes, and open rings."""
    people = load(spark, sf_dir, "customer").filter("c_acctbal > 0")
    x, y = F.col("c_custkey") % 32, F.floor(F.col("c_custkey") / 32)
    left, low = x + (y % 2) / 2, y.cast("double")
    ring = F.array(*[F.array(left + dx, low + dy) for dx, dy in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))])
    bricks = people.select(F.floor(y / 16).alias("region"), F.array(F.array(ring)).alias("geom"))
    out = rings.outlines(bricks, "region", digits=1)

    def length(r: Column) -> Column:
        sides = F.transform(F.sequence(F.lit(1), F.size(r) - 1), lambda i: F.abs(F.element_at(r, i + 1)[0] - F.element_at(r, i)[0]) + F.abs(F.element_at(r, i + 1)[1] - F.element_at(r, i)[1]))
        return F.aggregate(sides, F.lit(0.0), lambda total, v: total + v)

    loops = F.flatten("geom")
    whole = F.forall(loops, lambda r: (F.size(r) > 3) & (F.element_at(r, 1) == F.element_at(r, -1)))
    return out.select(
        "region", geo.planar_area(F.col("geom")).alias("area"),
        F.aggregate(F.transform(loops, length), F.lit(0.0), lambda total, v: total + v).alias("length"),
        (2 * F.size("geom") - F.size(loops)).cast("long").alias("parts_less_holes"), whole.alias("closed"),
    )


def merged_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    areas = D.areas(spark, sf_dir).withColumn("code", F.when(F.col("code") == "75101", S.CITY_CODE).otherwise(F.col("code")))
    shifted = F.transform("geom", lambda p: F.transform(p, lambda r: F.transform(r, lambda xy: F.transform(xy, lambda v: v + 0.123456))))
    merged = geo.merge_features(
        areas.withColumn("geom", shifted).filter(~C.in_city("code") | (F.col("code") == S.CITY_CODE)),
        areas.withColumn("geom", shifted).filter(C.in_city("code")),
    )
    return merged.select("code", "nom", F.col("geom")[0][0][0][0].alias("x"), F.col("geom")[0][0][0][1].alias("y"))


# --- quality ------------------------------------------------------------------


def source_ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables without a date, judged by the age of their files, some time after these were written."""
    found = []
    for table, days in (("customer", 100), ("part", 400), ("supplier", 800)):
        path = f"{sf_dir}/{table}.parquet"
        written = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).agg(F.max("modificationTime")).first()[0]
        today = F.date_add(F.lit(written).cast("date"), days)
        ages = quality.check_file_age(spark, path, today, *quality.FILE_AGES["income"])
        rows = load(spark, sf_dir, table).agg(F.count(F.lit(1)).alias("n"))
        found.append(ages.join(rows).select(F.lit(table).alias("table_name"), "age_days", "status", "n"))
    return text.union_by_name(found)


def quality_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = D.raw_communes(spark, sf_dir)
    return quality.check_not_null(m, "REG").select("COM", "TYPECOM")


def quality_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_unique(load(spark, sf_dir, "orders"), "o_custkey")


def quality_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_accepted_values(load(spark, sf_dir, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH", "5-LOW"])


def quality_relationship(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    people = load(spark, sf_dir, "customer").filter("c_acctbal > 0")
    return quality.check_relationship(orders, people, "o_custkey", "c_custkey")


def quality_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount")
    return quality.check_expression(rows, ~F.col("l_discount").between(0.01, 0.09))


def quality_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    today = F.lit("2001-12-01").cast("date")
    return quality.check_freshness(load(spark, sf_dir, "orders"), "o_orderdate", today, 90, 180)


def quality_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    return quality.row_counts({n: load(spark, sf_dir, n) for n in names})


def quality_all_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_all(models(spark, sf_dir))


# --- models -------------------------------------------------------------------


def model(name: str, digits: dict[str, int] | None = None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = models(spark, sf_dir)[name]
        return df.withColumns({c: F.round(c, d) for c, d in (digits or {}).items()})

    return query


def stage(table: str, step: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return step(D.RAW[table](spark, sf_dir))

    return query


def prices_commune_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return single(rounded(models(spark, sf_dir)["prices"], 6, *MEDIANS), *MEANS)


def tension_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models(spark, sf_dir)["tension"].orderBy("annee", "rang", "code_commune")


MART = {"prix_median": 6, "prix_m2_median": 6, "nb_faits_delinquance": 2}


def card(build: Callable[..., DataFrame], **options) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(tables(spark, sf_dir), **options)

    return query


OPERATORS: dict[str, Query] = {
    f.__name__: f
    for f in (
        price_stats_nation_year, price_evolution_nation, cumulative_change_nation,
        keep_largest_lot, exact_medians_by_segment, percent_rank_of_balance,
        clean_numeric_tokens, code_predicates, rounding_rules, age_structure_brand,
        age_group_shares, rate_per_thousand_user, category_rate_day, star_enrichment,
        region_restriction, latest_period, top_k_members, lookup_last_record,
        having_small_groups, distinct_by_user, zone_weighted_means, education_shares,
        incremental_orders, union_orders_by_name, csv_gzip_latin1, csv_many_headers, csv_many_headers_latin1, csv_typed,
        csv_export, serving_copies, versioned_load, geojson_lines, geojson_zone_documents,
        geojson_zone_lines, raw_full_replace, view_layer, table_layer, csv_ragged, records_stations,
        records_stops, records_counters, optional_source, sales_incremental,
        points_in_areas, area_km2, bike_density, station_lines, located_counters,
        dissolve_boundary, points_in_large_polygons, department_rings, keyed_load, csv_sniffed, source_ages, merged_features, quality_not_null, quality_unique,
        quality_accepted_values, quality_relationship, quality_expression, quality_freshness,
        quality_row_counts, quality_all_models, prices_commune_year, tension_ranking,
    )
}

MODELS: dict[str, Query] = {
    "transit_density": transit,
    "cycle_density": cycle,
    "model_sales": model("sales"),
    "model_sale_stats": stage("sale_stats", staging.clean_sale_stats),
    "model_communes": model("communes"),
    "model_income_stage": stage("income", staging.clean_income),
    "model_population_age": stage("population_age", staging.clean_population_age),
    "model_population": stage("population", staging.clean_population),
    "model_crime_total": stage("crime", lambda raw: rounded(staging.crime_total(raw), 2, "nb_faits_total")),
    "model_crime_detail": model("crime_detail"),
    "model_rents": stage("rents", staging.clean_rents),
    "model_communes_region": model("communes_region"),
    "model_income": model("income"),
    "model_age_structure": model("age_structure"),
    "accessibility_mart": lambda spark, sf_dir: single(model("accessibility", MART)(spark, sf_dir), *MEANS[:2]),
    "zone_rollup": model("zones"),
    "price_evolution": model(
        "evolution", {"prix_m2_median": 6, "prix_m2_median_annee_prec": 6}
    ),
    "city_prices_by_rooms": model("city_rooms"),
    "model_diplomas": model("diplomas"),
}


def all_queries() -> dict[str, Query]:
    queries = dict(OPERATORS) | dict(MODELS)
    for name, build in {**serving.REGION_CARDS, **serving.CITY_CARDS}.items():
        queries[f"serving_{name}"] = card(build)
    for name, build in serving.RING_CARDS.items():
        queries[f"serving_{name}"] = card(build, include_city=False)
        queries[f"serving_{name}_with_city"] = card(build, include_city=True)
    return queries
