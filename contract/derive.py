"""Raw tables of the domain, derived by Spark from the driver's tables.

An order is a sale, its lines are the lots, customers place it in a commune;
customers also give income, age, rent and diploma figures, events give crime.
The derived tables are all text and carry the usual dirt: padding, decimal
commas, blanks and markers for masked values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from territory.settings import Periods, Thresholds

LIMITS = Thresholds(year_min=1996)
PERIODS = Periods(latest=2000, crime=1999)

# Departments by nation; the last one lies outside the region.
DEPARTMENT_BY_NATION = ("75", "77", "78", "91", "92", "93", "94", "95", "60")
# Offences by event type.
OFFENCES = {
    "signup": "Vols sans violence contre des personnes",
    "view": "Usage de stupéfiants",
    "click": "Violences sexuelles",
    "error": "Cambriolages de logement",
    "purchase": "Escroqueries et fraudes",
}


_loaded: dict[tuple[str, str, str], DataFrame] = {}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The table as a lazy scan; its schema is read once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, table)
    if key not in _loaded:
        _loaded[key] = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return _loaded[key]


def text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def comma(c: Column) -> Column:
    return F.replace(text(c), F.lit("."), F.lit(","))


def lon_of(key: Column) -> Column:
    return F.pmod(key * 101, F.lit(5120)) / 128 + F.lit(1 / 256)


def lat_of(key: Column) -> Column:
    return F.pmod(key * 73, F.lit(512)) / 128 + F.lit(1 / 512)


def _choice(values: tuple[str, ...], index: str) -> str:
    return "element_at(array(" + ", ".join(f"'{v}'" for v in values) + f"), cast({index} + 1 as int))"


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with department and commune code."""
    city = "concat('1', lpad(string(1 + c_custkey % 20), 2, '0'))"
    other = "lpad(string(1 + c_custkey % 25), 3, '0')"
    return (
        load(spark, sf_dir, "customer")
        .selectExpr("*", f"{_choice(DEPARTMENT_BY_NATION, 'c_nationkey % 9')} as dep")
        .selectExpr("*", f"concat(dep, if(dep = '75', {city}, {other})) as code")
    )


def communes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per commune: customers, largest balance, customers by segment."""
    segments = ("HOUSEHOLD", "BUILDING", "FURNITURE", "MACHINERY")
    counts = [f"count_if(c_mktsegment = '{s}') as {s.lower()}" for s in segments]
    figures = ["count(*) as n", "max(c_acctbal) as m", *counts, "any_value(right(code, 2)) as tail"]
    return customers(spark, sf_dir).groupBy("code", "dep").agg(*[F.expr(f) for f in figures])


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    lots = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"
    )
    orders = load(spark, sf_dir, "orders")
    people = customers(spark, sf_dir).select("c_custkey", "code", "dep")
    sales = orders.join(people, F.col("o_custkey") == F.col("c_custkey"))
    rows = lots.join(sales, F.col("l_orderkey") == F.col("o_orderkey"))
    unplaced = F.col("o_custkey") % 50 == 7
    unpriced = (F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 31 == 0)
    unmeasured = (F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 7)
    kind = (
        F.when(F.col("l_returnflag") == "A", "Appartement ")
        .when(F.col("l_returnflag") == "R", " Maison")
        .otherwise("Dépendance")
    )
    return rows.select(
        F.concat(F.lit(" M"), text("l_orderkey"), F.lit(" ")).alias("id_mutation"),
        text("l_linenumber").alias("numero_disposition"),
        text(F.to_date("o_orderdate")).alias("date_mutation"),
        F.when(F.col("o_orderpriority") == "5-LOW", "Echange").otherwise(" Vente").alias("nature_mutation"),
        F.when(unplaced, " ").otherwise(F.col("code")).alias("code_commune"),
        F.concat(F.lit("Commune "), F.col("code")).alias("nom_commune"),
        F.col("dep").alias("code_departement"),
        F.concat("dep", F.lit("000")).alias("code_postal"),
        kind.alias("type_local"),
        text(1 + (F.col("l_linenumber") - 1) % 4).alias("nombre_pieces_principales"),
        F.when(unmeasured, "").otherwise(text(F.col("l_quantity") * 3)).alias("surface_reelle_bati"),
        F.lit("").alias("surface_terrain"),
        F.when(unpriced, "").otherwise(text("o_totalprice")).alias("valeur_fonciere"),
        text(lat_of(F.col("c_custkey"))).alias("latitude"),
        text(lon_of(F.col("c_custkey"))).alias("longitude"),
    )


def raw_communes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Communes and districts, each also listed as a delegated commune."""
    base = communes(spark, sf_dir)
    region = F.when(F.col("code") == "95025", F.lit(None)).when(
        F.col("dep") == "60", "32"
    ).otherwise("11")
    own = F.when(F.col("dep") == "75", " ARM").otherwise("COM ")
    return base.select(
        F.col("code").alias("COM"),
        F.concat(F.lit(" Commune "), F.col("code"), F.lit(" ")).alias("LIBELLE"),
        F.col("dep").alias("DEP"), region.alias("REG"),
        F.explode(F.array(own, F.lit("COMD"))).alias("TYPECOM"),
        F.when(F.col("dep") == "75", "75056").otherwise("").alias("COMPARENT"),
    )


def raw_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    level, n = F.col("m") + 1000, F.col("n")
    median = (
        F.when(F.col("tail") == "13", "s").when(F.col("tail") == "17", "nd")
        .when(F.col("tail") == "19", " NA").otherwise(comma(level))
    )
    return communes(spark, sf_dir).select(
        F.col("code").alias("CODGEO"),
        comma(level / 2).alias("Q121"), median.alias("Q221"), comma(level * 1.5).alias("Q321"),
        comma(level / 4 + n).alias("D121"), comma(level * 2).alias("D921"),
        comma(n / 1000).alias("GI21"), comma(30.5 + n % 50).alias("PMIMP21"), text(n).alias("NBMEN21"),
    )


def raw_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = text(F.col("n") * 100 + F.col("tail").cast("int"))
    return communes(spark, sf_dir).select(
        F.col("code").alias("CODGEO"), F.concat(F.lit("Commune "), F.col("code")).alias("LIBGEO"),
        F.when(F.col("tail") == "23", " ").otherwise(size).alias("PMUN2021"),
        text(F.col("n") * 90).alias("PMUN2015"),
    )


def raw_population_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    age = F.lpad(text(F.floor(key / 5) % 100), 3, "0")
    return customers(spark, sf_dir).select(
        F.col("code").alias("CODGEO"),
        text(1 + key % 2).alias("SEXE"),
        F.when(key % 41 == 0, "ENS").when(key % 43 != 0, age).alias("AGED100"),
        F.when(key % 47 == 0, " ").when(key % 53 != 0, text(10 + F.col("c_nationkey"))).alias("NB"),
    )


def raw_rents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rent = 10 + F.col("n") % 15 + F.col("tail").cast("int") / 100
    return communes(spark, sf_dir).filter(F.col("tail") != "05").select(
        F.col("code").alias("INSEE_C"), F.concat(F.lit("Commune "), F.col("code")).alias("LIBGEO"),
        F.col("dep").alias("DEP"), comma(rent).alias("loypredm2"),
        comma(rent - 1).alias("lwr.IPm2"), comma(rent + 1).alias("upr.IPm2"),
        F.lit(" commune").alias("TYPPRED"),
        F.when(F.col("n") % 4 == 0, "").otherwise(text("n")).alias("nbobs_com"),
    )


def raw_crime(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = customers(spark, sf_dir).select("c_custkey", "code")
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    rows = events.join(people, F.col("user_id") == F.col("c_custkey"))
    offence = F.create_map(*[F.lit(v) for pair in OFFENCES.items() for v in pair])
    key = F.col("event_id")
    return rows.select(
        F.col("code").alias("CODGEO_2025"),
        text(1995 + key % 6).alias("annee"),
        F.concat(offence[F.col("event_type")], F.lit(" ")).alias("indicateur"),
        F.when(key % 11 == 0, "ndiff").otherwise("diff ").alias("est_diffuse"),
        F.when(key % 29 == 0, "NA").otherwise(comma(F.col("value"))).alias("nombre"),
        F.lit("s").alias("taux_pour_mille"),
        text(1000 + F.right("code", F.lit(3)).cast("int")).alias("insee_pop"),
    )


def raw_diplomas(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.when(F.col("tail") == "21", 0).otherwise(F.col("n") * 10)
    return communes(spark, sf_dir).select(
        F.col("code").alias("CODGEO"), text(total).alias("P21_NSCOL15P"),
        text(F.col("household") * 7).alias("P21_NSCOL15P_DIPLMIN"),
        text(F.col("building") * 5).alias("P21_NSCOL15P_SUP2"),
        text(F.col("furniture") * 4).alias("P21_NSCOL15P_SUP34"),
        text(F.col("machinery") * 3).alias("P21_NSCOL15P_SUP5"),
    )


def raw_sale_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, price = F.col("p_size"), F.col("p_retailprice")
    measures = []
    for i, kind in enumerate(("appartement", "maison", "apt_maison", "local")):
        some = F.when(F.col("p_partkey") % (5 + i) != 0, text(size + i)).otherwise(" ")
        measures += [
            some.alias(f"nb_ventes_whole_{kind}"),
            F.concat(F.lit(" "), text(price + i)).alias(f"moy_prix_m2_whole_{kind}"),
            F.when(size % 7 != 0, text(price)).otherwise("").alias(f"med_prix_m2_whole_{kind}"),
        ]
    return load(spark, sf_dir, "part").select(
        F.when(F.col("p_partkey") % 97 != 0, F.concat(F.lit(" P"), text("p_partkey"))).alias("code_geo"),
        F.concat(F.col("p_name"), F.lit("  ")).alias("libelle_geo"),
        F.col("p_brand").alias("code_parent"), F.col("p_type").alias("echelle_geo"), *measures,
    )


RAW = {
    "sales": raw_sales, "communes": raw_communes, "income": raw_income,
    "population": raw_population, "population_age": raw_population_age, "rents": raw_rents,
    "crime": raw_crime, "diplomas": raw_diplomas, "sale_stats": raw_sale_stats,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: derive(spark, sf_dir) for name, derive in RAW.items()}


# --- geography: suppliers are areas, customers and orders are points ---------


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One diamond with a diamond-shaped hole per supplier, on a lattice 40
    wide: (code, nom, geom). Three sizes; large neighbours overlap a little."""
    placed = load(spark, sf_dir, "supplier").selectExpr(
        f"concat({_choice(DEPARTMENT_BY_NATION[:8], 's_suppkey % 8')},"
        " string(s_suppkey div 8 + 101)) as code",
        "s_name as nom", "double(s_suppkey % 40) as cx", "double(s_suppkey div 40) as cy",
        "0.75D - 0.125D * (s_suppkey % 3) as r",
    )

    def diamond(r: str) -> str:
        corners = ((r, "0D"), ("0D", r), (f"-{r}", "0D"), ("0D", f"-{r}"), (r, "0D"))
        return "array(" + ", ".join(f"array(cx + {dx}, cy + {dy})" for dx, dy in corners) + ")"

    return placed.selectExpr("code", "nom", f"array(array({diamond('r')}, {diamond('0.25D')})) as geom")


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return load(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), lat_of(key).alias("lat"), lon_of(key).alias("lon"),
        (10 + key % 30).cast("int").alias("capacity"),
    )


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    mode = F.when(key % 3 == 0, "RER").otherwise("Metro")
    return load(spark, sf_dir, "orders").select(
        F.struct((key % 3 == 0).cast("int").alias("source"), key.alias("pos")).alias("seq"),
        F.concat(F.lit("Stop "), text("o_custkey")).alias("stop_name"),
        lat_of(key).alias("lat"), lon_of(key).alias("lon"),
        mode.alias("mode"), F.concat(F.lit("L"), text(key % 16)).alias("line"),
    )


def cycle_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 20 + 1).alias("arrondissement"),
        F.col("l_extendedprice").alias("longueur_m"),
    )


def counter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id_compteur"),
        F.concat(F.lit("Compteur "), text("o_custkey")).alias("nom_compteur"),
        F.to_date("o_orderdate").alias("day"), F.floor("o_totalprice").alias("passages"),
    )


def counter_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return load(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id_compteur"), key.alias("seq"),
        F.when(key % 5 != 0, lat_of(key)).alias("lat"), lon_of(key).alias("lon"),
    )
