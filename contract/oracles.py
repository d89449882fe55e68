"""The registered queries as DuckDB SQL over the driver's tables.

Written from the definitions, not from the Spark code: a different formulation
on a different engine. Sums and means are plain ones; where a sum of doubles
is compared it is rounded on both sides. Rounding goes through the decimal text
of a double, so that both engines give equal values.
"""

from __future__ import annotations

from contract.derive import DEPARTMENT_BY_NATION, LIMITS, OFFENCES, PERIODS


def total(x: str) -> str:
    return f"sum(cast({x} as double))"


def mean(x: str) -> str:
    return f"avg(cast({x} as double))"


def rnd(x: str, digits: int = 0) -> str:
    exact = f"cast(cast({x} as varchar) as decimal(38,18))"
    return f"cast(cast(round({exact}, {digits}) as decimal(30,{digits})) as double)"


def single(x: str) -> str:
    """Single precision, where the order of addition does not show."""
    return f"cast(cast({x} as float) as double)"


def ratio(n: str, d: str) -> str:
    return f"(({n}) / nullif(cast({d} as double), 0))"


def wmean(v: str, w: str) -> str:
    return ratio(total(f"({v}) * ({w})"), total(w))


def band(age: str) -> str:
    return (
        f"case when {age} >= 95 then '95+' when {age} >= 0 then "
        f"printf('%02d-%02d', cast(floor({age} / 5) * 5 as int), cast(floor({age} / 5) * 5 + 4 as int)) "
        f"else 'inconnu' end"
    )


def category(offence: str) -> str:
    rules = [
        ("like 'Vols%'", "Vols"),
        ("like '%stupéfiants%'", "Stupéfiants"),
        ("like 'Violences%'", "Violences"),
        ("in ('Cambriolages de logement', 'Destructions et dégradations volontaires')", "Atteintes aux biens"),
    ]
    whens = " ".join(f"when {offence} {rule} then '{label}'" for rule, label in rules)
    return f"case {whens} else 'Escroqueries' end"


_deps = "[" + ", ".join(f"'{d}'" for d in DEPARTMENT_BY_NATION) + "]"
_area_deps = "[" + ", ".join(f"'{d}'" for d in DEPARTMENT_BY_NATION[:8]) + "]"
_offences = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in OFFENCES.items()) + "}"


def lon(key: str) -> str:
    return f"(({key} * 101) % 5120 / 128.0 + 1 / 256.0)"


def lat(key: str) -> str:
    return f"(({key} * 73) % 512 / 128.0 + 1 / 512.0)"


def dbl(x: str) -> str:
    return f"cast({x} as double)"


CTES = f"""
with cust0 as (
  select *, {_deps}[cast(c_nationkey % 9 + 1 as int)] as dep from customer
), cust as (
  select *, dep || case when dep = '75' then '1' || lpad(cast(1 + c_custkey % 20 as varchar), 2, '0')
                        else lpad(cast(1 + c_custkey % 25 as varchar), 3, '0') end as code
  from cust0
), comm as (
  select code, dep, right(code, 2) as tail, count(*) as n, max(c_acctbal) as m,
         count(*) filter (where c_mktsegment = 'HOUSEHOLD') as household,
         count(*) filter (where c_mktsegment = 'BUILDING') as building,
         count(*) filter (where c_mktsegment = 'FURNITURE') as furniture,
         count(*) filter (where c_mktsegment = 'MACHINERY') as machinery
  from cust group by code, dep
), geo as (
  select code as code_commune, 'Commune ' || code as nom_commune, dep as code_departement,
         case when code = '95025' then null when dep = '60' then '32' else '11' end as code_region,
         case when dep = '75' then 'Paris' when dep in ('92', '93', '94') then 'Petite couronne'
              when dep <> '60' then 'Grande couronne' end as zone_idf,
         case when dep = '75' then 'ARM' else 'COM' end as type_commune,
         case when dep = '75' then '75056' else '' end as code_commune_parent
  from comm
), region_geo as (select * from geo where code_region = '11'),
sales as (
  select 'M' || l_orderkey as id_mutation, cast(l_linenumber as varchar) as numero_disposition,
         'Vente' as nature_mutation, code as code_commune, 'Commune ' || code as nom_commune,
         dep as code_departement, dep || '000' as code_postal,
         case l_returnflag when 'A' then 'Appartement' when 'R' then 'Maison' else 'Dépendance' end as type_local,
         cast(o_orderdate as date) as date_mutation, cast(year(o_orderdate) as int) as annee,
         cast(1 + (l_linenumber - 1) % 4 as int) as nb_pieces,
         case when l_linestatus = 'F' and l_linenumber = 7 then null else l_quantity * 3 end as surface_bati,
         cast(null as double) as surface_terrain,
         case when o_orderstatus = 'P' and o_orderkey % 31 = 0 then null else o_totalprice end as valeur_fonciere,
         {dbl(lat('c_custkey'))} as latitude, {dbl(lon('c_custkey'))} as longitude
  from lineitem join orders on l_orderkey = o_orderkey join cust on o_custkey = c_custkey
  where o_orderpriority <> '5-LOW' and o_custkey % 50 <> 7
), picked as (
  select * from sales
  where type_local <> 'Dépendance' and valeur_fonciere > {LIMITS.price_min}
    and valeur_fonciere < {LIMITS.price_max} and surface_bati > {LIMITS.area_min}
    and surface_bati < {LIMITS.area_max}
    and code_commune in (select code_commune from region_geo)
  qualify row_number() over (partition by id_mutation
    order by surface_bati desc, numero_disposition, type_local) = 1
), prices as (
  select code_commune, annee, count(*) as nb_ventes,
         count(*) filter (where type_local = 'Appartement') as nb_ventes_appartements,
         count(*) filter (where type_local = 'Maison') as nb_ventes_maisons,
         median(valeur_fonciere) as prix_median, {mean('valeur_fonciere')} as prix_moyen,
         median(valeur_fonciere / surface_bati) as prix_m2_median,
         {mean('valeur_fonciere / surface_bati')} as prix_m2_moyen,
         median(surface_bati) as surface_mediane, {mean('surface_bati')} as surface_moyenne
  from picked where annee >= {LIMITS.year_min} group by code_commune, annee
), filo as (
  select code as code_commune,
         case when tail in ('13', '17', '19') then null else m + 1000 end as niveau_vie_median,
         (m + 1000) / 2 as niveau_vie_q1, (m + 1000) * 1.5 as niveau_vie_q3,
         (m + 1000) / 4 + n as niveau_vie_d1, (m + 1000) * 2 as niveau_vie_d9,
         n / 1000.0 as indice_gini, {rnd('100.0 - (30.5 + n % 50)', 1)} as taux_pauvrete_60,
         {dbl('n')} as nb_menages_fiscaux
  from comm
), pop as (
  select code as code_commune, 'Commune ' || code as nom_commune,
         case when tail <> '23' then {dbl('n * 100 + cast(tail as int)')} end as population_2021,
         {dbl('n * 90')} as population_2015
  from comm
), rents as (
  select code as code_commune, 'Commune ' || code as nom_commune, dep as code_departement,
         {dbl("10 + n % 15 + cast(tail as int) / 100")} as loyer_m2_median,
         {dbl("10 + n % 15 + cast(tail as int) / 100")} - 1 as loyer_m2_borne_basse,
         {dbl("10 + n % 15 + cast(tail as int) / 100")} + 1 as loyer_m2_borne_haute,
         'commune' as type_prediction,
         case when n % 4 <> 0 then cast(n as int) end as nb_observations_commune
  from comm where tail <> '05'
), inc as (
  select g.code_commune, g.nom_commune, g.code_departement, g.zone_idf, niveau_vie_median,
         niveau_vie_q1, niveau_vie_q3, niveau_vie_d1, niveau_vie_d9, indice_gini,
         taux_pauvrete_60, nb_menages_fiscaux, population_2021, loyer_m2_median,
         {rnd(ratio('niveau_vie_d9', 'niveau_vie_d1'), 2)} as ratio_interdecile_d9_d1
  from region_geo g left join filo using (code_commune) left join pop using (code_commune)
       left join rents using (code_commune)
), ages0 as (
  select code as code_commune, cast(1 + c_custkey % 2 as varchar) as sexe,
         lpad(cast((c_custkey // 5) % 100 as varchar), 3, '0') as age_revolu,
         cast((c_custkey // 5) % 100 as int) as age_int,
         case when c_custkey % 47 <> 0 then {dbl('10 + c_nationkey')} end as effectif
  from cust where c_custkey % 41 <> 0 and c_custkey % 43 <> 0 and (c_custkey % 53 <> 0 or c_custkey % 47 = 0)
), ages as (
  select *, {band('age_int')} as tranche_age_quinquennale from ages0
), age_struct as (
  select code_commune, {total('effectif')} as population_totale,
         {total('case when age_int between 25 and 39 then effectif else 0 end')} as pop_25_39,
         {total('case when age_int >= 60 then effectif else 0 end')} as pop_60_plus
  from ages where code_commune in (select code_commune from region_geo) group by code_commune
), age_mart as (
  select *, {rnd(ratio('pop_25_39', 'population_totale'), 4)} as part_25_39,
         {rnd(ratio('pop_60_plus', 'population_totale'), 4)} as part_60_plus
  from age_struct
), crime as (
  select code as code_commune, cast(1995 + event_id % 6 as int) as annee,
         {_offences}[event_type] as type_delit,
         case when event_id % 29 <> 0 then value end as nb_faits, cast(null as double) as taux_pour_mille,
         {dbl("1000 + cast(right(code, 3) as int)")} as population
  from events join cust on user_id = c_custkey where event_id % 11 <> 0
), crime_tot as (
  select code_commune, annee, {total('nb_faits')} as nb_faits_total, max(population) as population
  from crime group by code_commune, annee
), crime_rate as (
  select *, {rnd(ratio('nb_faits_total', 'population') + ' * 1000', 1)} as taux_delinquance_pour_mille
  from crime_tot
), det as (select * from crime where nb_faits is not null),
acc as (
  select i.code_commune, i.nom_commune, i.code_departement, i.zone_idf, p.annee, population_2021,
         population_totale as population_rp, pop_25_39, part_25_39, part_60_plus,
         niveau_vie_median, niveau_vie_q1, niveau_vie_q3, taux_pauvrete_60, indice_gini,
         ratio_interdecile_d9_d1, nb_menages_fiscaux, loyer_m2_median, nb_ventes,
         nb_ventes_appartements, nb_ventes_maisons, prix_median, prix_moyen, prix_m2_median,
         prix_m2_moyen, surface_mediane, taux_delinquance_pour_mille,
         nb_faits_total as nb_faits_delinquance,
         {rnd(ratio('prix_m2_median', 'niveau_vie_median / 12'), 1)} as ratio_prix_m2_revenu_mensuel,
         {rnd(ratio('prix_median', 'niveau_vie_median'), 1)} as ratio_achat_revenu_annuel,
         {rnd(ratio('prix_median', 'niveau_vie_q1'), 1)} as ratio_achat_revenu_q1,
         {rnd(ratio('prix_m2_median', 'loyer_m2_median * 12'), 1)} as ratio_achat_loyer_annuel
  from prices p join inc i using (code_commune) left join age_mart using (code_commune)
       left join crime_rate c on c.code_commune = i.code_commune and c.annee = p.annee
  where nb_ventes >= {LIMITS.sales_min} and niveau_vie_median is not null
), zones as (
  select zone_idf, annee, {total('population_2021')} as population_totale, count(*) as nb_communes,
         cast(sum(nb_ventes) as bigint) as nb_ventes_total,
         {rnd(wmean('prix_m2_median', 'nb_ventes'))} as prix_m2_median_pondere,
         {rnd(wmean('prix_median', 'nb_ventes'))} as prix_median_pondere,
         {rnd(wmean('niveau_vie_median', 'population_2021'))} as niveau_vie_median_pondere,
         {rnd(wmean('part_25_39', 'population_2021'), 4)} as part_25_39_ponderee,
         {rnd(wmean('ratio_achat_revenu_annuel', 'nb_ventes'), 1)} as ratio_achat_revenu_pondere,
         {rnd(wmean('ratio_prix_m2_revenu_mensuel', 'nb_ventes'), 1)} as ratio_m2_revenu_pondere
  from acc group by zone_idf, annee
), evo0 as (
  select g.code_commune, g.nom_commune, g.code_departement, g.zone_idf, annee, nb_ventes,
         prix_m2_median, prix_median,
         lag(prix_m2_median) over w as prix_m2_median_annee_prec,
         lag(prix_median) over w as prix_median_annee_prec
  from prices join region_geo g using (code_commune) where nb_ventes >= {LIMITS.sales_min}
  window w as (partition by code_commune order by annee)
), evo as (
  select *,
    {rnd(ratio('prix_m2_median - prix_m2_median_annee_prec', 'prix_m2_median_annee_prec') + ' * 100', 1)} as variation_prix_m2_pct,
    {rnd(ratio('prix_median - prix_median_annee_prec', 'prix_median_annee_prec') + ' * 100', 1)} as variation_prix_median_pct
  from evo0
), rooms as (
  select code_commune, nom_commune, nb_pieces, annee, count(*) as nb_ventes,
         {rnd('median(valeur_fonciere)')} as prix_median,
         {rnd('median(valeur_fonciere / surface_bati)')} as prix_m2_median,
         {rnd('median(surface_bati)', 1)} as surface_mediane
  from sales
  where type_local = 'Appartement' and nb_pieces between 1 and 3
    and valeur_fonciere > {LIMITS.rooms_price_min} and code_commune like '751%'
  group by all having count(*) >= {LIMITS.sales_min}
), dip as (
  select code as code_commune, {dbl('n * 10')} as pop_15p_non_scol,
         {rnd(ratio('household * 7', 'n * 10') + ' * 100', 1)} as part_sans_diplome,
         {rnd(ratio('building * 5 + furniture * 4 + machinery * 3', 'n * 10') + ' * 100', 1)} as part_etudes_sup,
         {rnd(ratio('machinery * 3', 'n * 10') + ' * 100', 1)} as part_bac5_plus
  from comm where tail <> '21'
), tension0 as (
  select code_commune, nom_commune, code_departement, zone_idf, annee,
         percent_rank() over (partition by annee order by ratio_achat_revenu_annuel) * 0.4::double
       + percent_rank() over (partition by annee order by ratio_prix_m2_revenu_mensuel) * 0.3::double
       + percent_rank() over (partition by annee order by part_25_39 desc) * 0.15::double
       + percent_rank() over (partition by annee order by taux_pauvrete_60) * 0.15::double as score
  from acc where ratio_achat_revenu_annuel is not null and ratio_prix_m2_revenu_mensuel is not null
    and part_25_39 is not null and taux_pauvrete_60 is not null
), tension1 as (
  select * exclude (score),
    {rnd('percent_rank() over (partition by annee order by score) * 100', 1)} as indice_tension
  from tension0
), tension as (
  select *, rank() over (partition by annee order by indice_tension desc) as rang from tension1
), area as (
  select {_area_deps}[cast(s_suppkey % 8 + 1 as int)] || cast(s_suppkey // 8 + 101 as varchar) as code,
         s_name as nom, s_suppkey % 40 as cx, s_suppkey // 40 as cy,
         0.75::double - 0.125::double * (s_suppkey % 3) as r, 2 * (r * r - 0.0625::double) as flat,
         flat * 111.12::double * 111.12::double * 0.6583::double as km2
  from supplier
), tagged as (
  select c_custkey, c_name as name, {dbl(lat('c_custkey'))} as lat, {dbl(lon('c_custkey'))} as lon,
         cast(10 + c_custkey % 30 as int) as capacity, code as code_commune, nom as nom_commune
  from customer join area
    on abs({lon('c_custkey')} - cx) + abs({lat('c_custkey')} - cy) between 0.25 and r
), stop_line as (
  select distinct 'Stop ' || o_custkey as name, 'L' || o_orderkey % 16 as line, o_custkey from orders
), stop_pos as (
  select o_custkey, {dbl(lat('o_orderkey'))} as lat, {dbl(lon('o_orderkey'))} as lon from orders
  qualify row_number() over (partition by o_custkey
    order by case when o_orderkey % 3 = 0 then 1 else 0 end, o_orderkey) = 1
), station_line as (
  select name, lat, lon, line from stop_line join stop_pos using (o_custkey)
), transit as (
  select code as code_commune, nom as nom_commune, cast(count(distinct name) as int) as nb_stations,
         cast(count(distinct line) as int) as nb_lignes_uniques,
         {rnd('any_value(km2)', 2)} as superficie_km2,
         {rnd('count(distinct name) / any_value(km2)', 1)} as stations_par_km2
  from station_line join area on abs(lon - cx) + abs(lat - cy) between 0.25 and r
  group by code, nom
), cyc as (
  select code as code_commune, nom as nom_commune, arrondissement, longueur_km,
         {rnd('longueur_km / km2', 1)} as km_par_km2
  from (select cast(l_suppkey % 20 + 1 as int) as arrondissement,
               {rnd(total('l_extendedprice') + ' / 1000', 1)} as longueur_km
        from lineitem group by 1)
  join area on code = '751' || lpad(cast(arrondissement as varchar), 2, '0')
), nation_lot as (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, o_totalprice,
         c_nationkey as nation, cast(year(o_orderdate) as int) as annee
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
  where l_returnflag in ('A', 'R') and l_quantity > 5 and o_totalprice > 1000
), nation_price as (
  select nation, annee, count(*) as nb_ventes,
         count(*) filter (where l_returnflag = 'A') as nb_ventes_a,
         count(*) filter (where l_returnflag = 'R') as nb_ventes_r,
         median(o_totalprice) as prix_median, {mean('o_totalprice')} as prix_moyen,
         median(o_totalprice / l_quantity) as prix_m2_median,
         {mean('o_totalprice / l_quantity')} as prix_m2_moyen,
         median(l_quantity) as surface_mediane, {mean('l_quantity')} as surface_moyenne
  from (select * from nation_lot qualify row_number() over (partition by l_orderkey
          order by l_quantity desc, l_linenumber, l_partkey, l_suppkey, l_returnflag) = 1)
  group by nation, annee
)
"""

_MEANS = ("prix_median", "prix_moyen", "prix_m2_median", "prix_m2_moyen", "surface_mediane", "surface_moyenne")
_SIX = ", ".join(f"{single(c) if 'moyen' in c or c == 'surface_moyenne' else rnd(c, 6)} as {c}" for c in _MEANS)
_token = (
    "case o_orderkey % 7 when 0 then '' when 1 then 's' when 2 then 'nd' when 3 then 'NA' "
    "else replace(cast(o_totalprice as varchar), '.', ',') end"
)
_number = "case when o_orderkey % 7 >= 4 then o_totalprice end"


def _checks() -> str:
    geo, inc, age, acc = "region_geo", "inc", "age_mart", "acc"

    def nulls(t: str, c: str) -> str:
        return f"select count(*) from {t} where {c} is null"

    def repeats(t: str, c: str) -> str:
        return f"select count(*) from (select {c} from {t} where {c} is not null group by 1 having count(*) > 1)"

    def unknown(t: str) -> str:
        return f"select count(*) from {t} where code_commune is not null and code_commune not in (select code_commune from {geo})"

    def zone(t: str) -> str:
        return f"select count(*) from {t} where zone_idf not in ('Paris', 'Petite couronne', 'Grande couronne')"

    def rows(t: str, c: str) -> str:
        return f"select count(*) from {t} where {c}"

    checks = {
        "stage_sales_code_not_null": nulls("sales", "code_commune"),
        "stage_sale_stats_code_not_null": "select 0",
        "stage_communes_code_not_null": nulls("geo", "code_commune"),
        "stage_communes_code_unique": repeats("geo", "code_commune"),
        "stage_income_code_not_null": nulls("filo", "code_commune"),
        "stage_population_code_not_null": nulls("pop", "code_commune"),
        "stage_population_age_code_not_null": nulls("ages", "code_commune"),
        "stage_rents_code_not_null": nulls("rents", "code_commune"),
        "stage_crime_total_code_not_null": nulls("crime_rate", "code_commune"),
        "stage_crime_detail_code_not_null": nulls("det", "code_commune"),
        "ages_total_not_null": nulls(age, "population_totale"),
        "mart_sales_not_null": nulls(acc, "nb_ventes"),
        "mart_price_not_null": nulls(acc, "prix_median"),
        "mart_price_m2_not_null": nulls(acc, "prix_m2_median"),
        "communes_code_not_null": nulls(geo, "code_commune"),
        "communes_code_unique": repeats(geo, "code_commune"),
        "communes_zone_not_null": nulls(geo, "zone_idf"),
        "communes_zone_accepted": zone(geo),
        "prices_code_not_null": nulls("prices", "code_commune"),
        "prices_code_known": unknown("prices"),
        "prices_year_not_null": nulls("prices", "annee"),
        "prices_sales_not_null": nulls("prices", "nb_ventes"),
        "income_code_not_null": nulls(inc, "code_commune"),
        "income_code_unique": repeats(inc, "code_commune"),
        "income_code_known": unknown(inc),
        "ages_code_not_null": nulls(age, "code_commune"),
        "ages_code_unique": repeats(age, "code_commune"),
        "ages_code_known": unknown(age),
        "mart_code_not_null": nulls(acc, "code_commune"),
        "mart_year_not_null": nulls(acc, "annee"),
        "mart_zone_not_null": nulls(acc, "zone_idf"),
        "mart_zone_accepted": zone(acc),
        "zones_zone_not_null": nulls("zones", "zone_idf"),
        "zones_zone_accepted": zone("zones"),
        "zones_year_not_null": nulls("zones", "annee"),
        "evolution_code_not_null": nulls("evo", "code_commune"),
        "evolution_code_known": unknown("evo"),
        "evolution_year_not_null": nulls("evo", "annee"),
        "crime_rate_positive": rows(acc, "taux_delinquance_pour_mille < 0"),
        "rent_positive": rows(acc, "loyer_m2_median <= 0"),
        "young_share_range": rows(age, "part_25_39 < 0 or part_25_39 > 1"),
        "age_shares_consistent": rows(age, "part_60_plus < 0 or part_60_plus > 1 or part_25_39 + part_60_plus > 1.01"),
        "price_m2_positive": rows(acc, "prix_m2_median <= 0"),
        "purchase_ratio_plausible": rows(acc, "nb_ventes >= 10 and (ratio_achat_revenu_annuel < 1 or ratio_achat_revenu_annuel > 150)"),
        "median_area_plausible": rows(acc, "surface_mediane < 5 or surface_mediane > 500"),
    }
    return " union all ".join(f"select '{name}' as table_name, ({sql}) as n" for name, sql in checks.items())


_age_groups = {
    "15_24": "p_size * 2 - 5 between 15 and 24", "25_39": "p_size * 2 - 5 between 25 and 39",
    "40_59": "p_size * 2 - 5 between 40 and 59", "60_plus": "p_size * 2 - 5 >= 60",
}
_group_sums = ", ".join(f"{total(f'case when {w} then p_retailprice else 0 end')} as g_{g}" for g, w in _age_groups.items())
_group_columns = ", ".join(
    f"{rnd(f'g_{g}', 2)} as pop_{g}, {rnd(ratio(f'g_{g}', 't'), 4)} as part_{g}" for g in _age_groups
)

_zone_rows = " union all ".join(
    f"select '{zone}' as zone, code, nom, {rnd('flat', 6)} as area, cx + r as x, cast(cy as double) as y from area where {where}"
    for zone, where in {
        "idf_communes": "true",
        "paris_arrondissements": "code like '751%'",
        "petite_couronne": "left(code, 2) in ('92', '93', '94')",
        "petite_couronne_plus_paris": "left(code, 2) in ('92', '93', '94') or code like '751%'",
        "grande_couronne": "left(code, 2) in ('77', '78', '91', '95')",
    }.items()
)

OPERATORS: dict[str, str] = {
    "price_stats_nation_year": f"select nation, annee, nb_ventes, nb_ventes_a, nb_ventes_r, {_SIX} from nation_price",
    "price_evolution_nation": f"""
        select nation, annee, nb_ventes, {rnd('prix_m2_median', 6)} as prix_m2_median, prix_median,
               {rnd('lag(prix_m2_median) over w', 6)} as prix_m2_prec, lag(prix_median) over w as prix_prec,
               {rnd(ratio('prix_m2_median - lag(prix_m2_median) over w', 'lag(prix_m2_median) over w') + ' * 100', 1)} as variation_m2,
               {rnd(ratio('prix_median - lag(prix_median) over w', 'lag(prix_median) over w') + ' * 100', 1)} as variation
        from nation_price where nb_ventes >= 5 window w as (partition by nation order by annee)""",
    "cumulative_change_nation": f"""
        select nation, annee, prix_median,
               {rnd(ratio('prix_median - first_value(prix_median) over w', 'first_value(prix_median) over w') + ' * 100', 1)} as cumul
        from nation_price where nb_ventes >= 5 window w as (partition by nation order by annee)""",
    "keep_largest_lot": """
        select l_orderkey, l_quantity, l_extendedprice, l_linenumber, l_partkey, l_suppkey, l_returnflag
        from lineitem qualify row_number() over (partition by l_orderkey
          order by l_quantity desc, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_extendedprice) = 1""",
    "exact_medians_by_segment": f"""
        select o_orderpriority, count(*) as price_count, median(o_totalprice) as price_median,
               {single(mean('o_totalprice'))} as price_mean, {rnd(total('o_totalprice'), 2)} as price_sum,
               {dbl('median(month(o_orderdate))')} as month_median
        from orders group by 1""",
    "percent_rank_of_balance": f"""
        select c_mktsegment, c_acctbal, count(*) as n, {rnd('any_value(pr)', 9)} as pr
        from (select c_mktsegment, c_acctbal,
                     percent_rank() over (partition by c_mktsegment order by c_acctbal) as pr from customer)
        group by 1, 2""",
    "clean_numeric_tokens": f"""
        select o_orderkey, {_token} as trimmed, {_number} as number,
               case when o_orderkey % 5 <> 0 then cast(o_orderkey % 9 as varchar) || '.4' end as filled,
               case when o_orderkey % 5 <> 0 then cast(o_orderkey % 9 as int) end as rooms,
               o_orderkey % 5 <> 0 as has_rooms,
               {rnd(ratio(_number, 'o_orderkey % 4'), 4)} as ratio
        from orders""",
    "code_predicates": """
        select c_custkey, code, left(code, 2) as department, cast(right(code, 2) as int) as district,
               '751' || lpad(cast(c_custkey % 20 + 1 as varchar), 2, '0') as district_code,
               code like '751%' as in_city, dep <> '60' as in_departments,
               left(code, 2) in ('92', '93', '94') or code like '751%' as ring_with_city,
               dep in ('92', '93', '94') as ring,
               case when dep <> '95' then dep <> '60' end as in_region
        from cust""",
    "rounding_rules": f"""
        select p_partkey, {rnd('p_retailprice / 8', 1)} as tenth, {rnd('p_retailprice / 8', 2)} as hundredth,
               {dbl('round_even(p_size / 2, 0)')} as half_even, {rnd('p_size / 2')} as half_up,
               {rnd('100.0 - p_retailprice / 16', 1)} as complement
        from part""",
    "age_structure_brand": f"""
        select p_brand, band, amount, total, {rnd(ratio('amount', 'total'), 4)} as share from (
          select p_brand, band, {total('p_size + 0.5')} as amount,
                 sum({total('p_size + 0.5')}) over (partition by p_brand) as total
          from (select p_brand, p_size, {band('age')} as band
                from (select *, case when p_partkey % 13 <> 0 then p_size * 3 - 10 end as age from part))
          group by p_brand, band)""",
    "age_group_shares": f"""
        select p_brand, {rnd('t', 2)} as total, {_group_columns}
        from (select p_brand, {total('p_retailprice')} as t, {_group_sums} from part group by p_brand)""",
    "rate_per_thousand_user": f"""
        select user_id, day, {rnd('f', 2)} as facts, population, {rnd(ratio('f', 'population') + ' * 1000', 1)} as rate
        from (select user_id, cast(day(ts) as int) as day, {total('value')} as f,
                     {dbl('max(case when user_id % 10 <> 0 then user_id * 3 else 0 end)')} as population
              from events group by 1, 2)""",
    "category_rate_day": f"""
        select category, day, {rnd(ratio(total('value'), total('user_id + 100')) + ' * 1000', 1)} as rate
        from (select {category(f'{_offences}[event_type]')} as category, cast(day(ts) as int) as day, value, user_id from events)
        group by 1, 2""",
    "star_enrichment": """
        select c_custkey, c_nationkey as nation, n_name, n_regionkey as region, r_name, best_supplier
        from customer left join nation on c_nationkey = n_nationkey
        join (select s_nationkey, max(s_acctbal) as best_supplier from supplier group by 1
              having max(s_acctbal) > 5000) on s_nationkey = c_nationkey
        left join region on n_regionkey = r_regionkey and r_regionkey <> 3""",
    "region_restriction": """
        select c_custkey, c_nationkey from customer
        where c_nationkey in (select n_nationkey from nation where n_regionkey in (1, 2))""",
    "latest_period": """
        select event_id, value as v from events where event_type = 'error' and cast(ts as date) =
          (select max(cast(ts as date)) from events where event_type = 'error')""",
    "top_k_members": """
        select o_custkey, o_orderkey, o_totalprice from orders where o_custkey in (
          select o_custkey from orders group by 1 order by count(*) desc, o_custkey limit 10)""",
    "lookup_last_record": """
        select o_custkey as c_custkey, c_name, o_orderkey, o_totalprice as price from (
          select * from orders qualify row_number() over (partition by o_custkey order by o_orderkey desc) = 1)
        join customer on c_custkey = o_custkey where o_orderstatus <> 'P'""",
    "having_small_groups": f"""
        select o_custkey, cast(year(o_orderdate) as int) as annee, count(*) as nb, {rnd('median(o_totalprice)')} as prix_median
        from orders where o_totalprice > 10000 group by 1, 2 having count(*) >= 5""",
    "distinct_by_user": """
        select user_id, count(distinct event_type) as types, count(distinct cast(ts as date)) as days
        from events group by 1""",
    "zone_weighted_means": f"""
        select c_nationkey, count(*) as n, {total('w')} as w, {rnd(wmean('v', 'w'), 1)} as mean_1, {rnd(wmean('v', 'w'), 4)} as mean_4
        from (select c_nationkey, case when c_custkey % 6 <> 0 then c_acctbal end as v, {dbl('c_custkey % 17')} as w from customer)
        group by 1""",
    "education_shares": f"""
        select p_brand as code_commune, {dbl('t')} as pop_15p_non_scol,
               {rnd(ratio('a', 't') + ' * 100', 1)} as part_sans_diplome,
               {rnd(ratio('b', 't') + ' * 100', 1)} as part_etudes_sup,
               {rnd(ratio('c', 't') + ' * 100', 1)} as part_bac5_plus
        from (select p_brand, count(*) as t, count(*) filter (where p_type = 'ECONOMY') as a,
                     count(*) filter (where p_type in ('SMALL', 'PROMO', 'MEDIUM')) as b,
                     count(*) filter (where p_type = 'MEDIUM') as c from part group by 1)""",
    "incremental_orders": """
        , incoming as (
          select case when o_orderkey % 4 = 0 then o_orderkey // 2 else o_orderkey end as o_orderkey,
                 cast(o_orderdate as date) as day, o_totalprice, cast(o_orderkey as varchar) as source
          from orders where o_orderdate >= timestamp '2000-01-01'
        )
        select * from incoming union all
        select o_orderkey, cast(o_orderdate as date), o_totalprice, null from orders
        where o_orderdate < timestamp '2000-01-01' and o_orderkey not in (select o_orderkey from incoming)""",
    "union_orders_by_name": """
        select o_orderkey, case when o_orderstatus = 'O' then o_totalprice end as o_totalprice,
               case when o_orderstatus = 'O' then o_orderstatus end as o_orderstatus,
               case when o_orderstatus <> 'O' then o_custkey end as o_custkey from orders""",
    "csv_gzip_latin1": "select c_custkey, 'Clé ' || c_name as nom, c_acctbal as solde from customer",
    "csv_many_headers": """
        select o_orderkey, o_totalprice, o_orderstatus,
               case when o_orderstatus = 'O' then o_orderpriority end as o_orderpriority from orders""",
    "csv_many_headers_latin1": """
        select c_custkey as k, c_name as name, cast(null as int) as nation from customer union all
        select c_custkey, null, c_nationkey from customer""",
    "csv_typed": "select p_partkey, p_brand, p_size, p_retailprice from part",
    "csv_export": "select code_commune, annee, prix_median, loyer_m2_median from acc",
    "serving_copies": """
        select 'accessibility' as table_name, count(*) as n from acc union all
        select 'zones', count(*) from zones union all
        select 'evolution', count(*) from evo union all
        select 'crime_detail', count(*) from det""",
    "versioned_load": """
        select o_orderkey, cast(o_orderdate as date) as day,
               case when mark < cast(o_orderdate as date) then o_totalprice + 1 else o_totalprice end as o_totalprice
        from orders, (select max(cast(o_orderdate as date)) as mark from orders where o_orderdate < timestamp '1999-06-01')""",
    "geojson_lines": "select code, nom, flat as area from area",
    "geojson_zone_documents": _zone_rows,
    "geojson_zone_lines": _zone_rows,
    "raw_full_replace": "select -1 - o_orderkey as o_orderkey, o_totalprice + 1 as o_totalprice from orders",
    "view_layer": "select o_orderkey, o_totalprice from orders where o_orderstatus = 'F'",
    "table_layer": "select o_orderkey, o_totalprice, o_orderstatus from orders where o_orderstatus = 'F'",
    "csv_ragged": """
        select p_partkey, p_brand, case when p_partkey % 5 <> 0 then p_size end as p_size, 'padded' as mode from part union all
        select p_partkey, p_brand, p_size, 'skipped' from part where p_partkey % 5 <> 0""",
    "records_stations": "select cast(c_custkey as varchar) as code, c_name as name, 2.5 as lat, 48.5 as lon, cast(c_custkey % 40 as int) as capacity from customer",
    "records_stops": """
        select cast(source as int) as source, stop_name, lat, line from (
          select 0 as source, s_name as stop_name, cast(s_suppkey as double) as lat, 'M' || s_suppkey % 14 as line from supplier union all
          select 1, n_name, cast(n_nationkey as double), 'R' || n_regionkey from nation)""",
    "records_counters": """
        select cast(s_suppkey % 50 as varchar) as id_compteur, max_by(cast(s_suppkey as double), s_suppkey) as lat
        from supplier group by 1""",
    "optional_source": "select 'present' as state, count(*) as n from part union all select 'absent', 0",
    "sales_incremental": """
        , old as (select id_mutation, numero_disposition, date_mutation, valeur_fonciere from sales where date_mutation <= date '1999-12-31'),
        mark as (select max(date_mutation) as d from old),
        fresh as (
          select case when hash_key % 4 = 0 then 'M' || hash_key // 2 else id_mutation end as id_mutation,
                 numero_disposition, date_mutation, valeur_fonciere
          from (select *, cast(substr(id_mutation, 2) as bigint) as hash_key from sales), mark where date_mutation > d)
        select * from fresh union all select * from old where id_mutation not in (select id_mutation from fresh)""",
    "points_in_areas": "select name, lat, lon, capacity, code_commune, nom_commune from tagged",
    "area_km2": f"select code as code_commune, {rnd('km2', 6)} as area_km2 from area",
    "bike_density": f"""
        select code_commune, nom_commune, cast(count(*) as int) as nb_stations,
               cast(sum(capacity) as int) as capacite_totale, {rnd('any_value(km2)', 2)} as superficie_km2,
               {rnd('count(*) / any_value(km2)', 1)} as stations_par_km2
        from tagged join area on code = code_commune group by 1, 2""",
    "station_lines": "select name, lat, lon, line from station_line",
    "located_counters": f"""
        , busiest as (
          select o_custkey, 'Compteur ' || o_custkey as nom, cast(sum(floor(o_totalprice)) as bigint) as total_passages
          from orders where cast(o_orderdate as date) >= date '1998-03-01' and cast(o_orderdate as date) < date '1998-04-01'
          group by 1, 2 order by 3 desc, 1, 2 limit 30
        )
        select nom, {dbl(lat('last_key'))} as lat, {dbl(lon('last_key'))} as lon, total_passages
        from busiest join (select o_custkey, max(o_orderkey) as last_key from orders group by 1) using (o_custkey)
        where last_key % 5 <> 0""",
    "dissolve_boundary": """
        , square as (select s_suppkey % 3 as region, s_suppkey % 5 as x, s_suppkey // 5 as y from supplier),
        side as (
          select region, x as x1, y as y1, x + 1 as x2, y as y2 from square union all
          select region, x, y + 1, x + 1, y + 1 from square union all
          select region, x, y, x, y + 1 from square union all
          select region, x + 1, y, x + 1, y + 1 from square
        )
        select region, cast(x1 as double) as x1, cast(y1 as double) as y1, cast(x2 as double) as x2, cast(y2 as double) as y2
        from side group by all having count(*) = 1""",
    "keyed_load": """
        select o_orderkey, cast(o_orderdate as date) as day, o_totalprice from orders where o_orderkey % 100 <> 7 union all
        select o_orderkey, cast(o_orderdate as date) + 10000, o_totalprice * 2 from orders where o_orderkey % 100 = 7""",
    "csv_sniffed": """
        select cast(kind as int) as kind, c_custkey, 'a,b;c' || chr(9) || '|' || c_name || ';,|' as label, c_nationkey
        from customer, range(4) k(kind)""",
    "source_ages": """
        select 'customer' as table_name, 100 as age_days, 'pass' as status, count(*) as n from customer union all
        select 'part', 400, 'warn', count(*) from part union all
        select 'supplier', 800, 'error', count(*) from supplier""",
    "points_in_large_polygons": """
        , corner as (
          select o_orderkey // 8192 as block, o_orderkey % 8192 as x, floor(o_totalprice % 997) / 8 + 1 as h,
                 lead(o_orderkey % 8192) over (partition by o_orderkey // 8192 order by o_orderkey) as nx,
                 lead(floor(o_totalprice % 997) / 8 + 1) over (partition by o_orderkey // 8192 order by o_orderkey) as nh
          from orders
        ),
        spot as (select l_orderkey, l_linenumber, l_orderkey // 8192 as block, l_orderkey % 8192 as x, floor(l_extendedprice % 1009) / 8 + 0.0137::double as y from lineitem)
        select l_orderkey, l_linenumber, block from spot join corner using (block)
        where corner.x <= spot.x and spot.x < nx and y < h + (nh - h) * (spot.x + 0.5::double - corner.x) / (nx - corner.x)""",
    "department_rings": """
        , brick as (select c_custkey // 32 // 16 as region, 2 * (c_custkey % 32) + (c_custkey // 32) % 2 as x, c_custkey // 32 as y from customer where c_acctbal > 0),
        half as (select region, x + i as x, y + j as y from brick, range(2) a(i), range(2) b(j)),
        upright as (select region, x + 2 * i as x, y from brick, range(2) a(i)),
        vertex as (select distinct region, x + i as x, y + j as y from brick, range(3) a(i), range(2) b(j)),
        h as (select region, x, y, count(*) as n from half group by all),
        u as (select region, x, y, count(*) as n from upright group by all)
        select region, cast(count(*) as double) as area,
               cast((select count(*) from h where n = 1 and h.region = brick.region) / 2 + (select count(*) from u where n = 1 and u.region = brick.region) as double) as length,
               (select count(*) from vertex where vertex.region = brick.region) - (select count(*) from h where h.region = brick.region)
                 - (select count(*) from u where u.region = brick.region) + count(*) as parts_less_holes,
               true as closed
        from brick group by region""",
    "merged_features": f"""
        select code, nom, {rnd('cx + r + 0.123456::double', 4)} as x, {rnd('cy + 0.123456::double', 4)} as y
        from area where code <> '75101'""",
    "quality_not_null": """
        select code as COM, unnest([case when dep = '75' then ' ARM' else 'COM ' end, 'COMD']) as TYPECOM
        from comm where code = '95025'""",
    "quality_unique": "select o_custkey, count(*) as n from orders group by 1 having count(*) > 1",
    "quality_accepted_values": """
        select o_orderpriority, count(*) as n from orders
        where o_orderpriority not in ('1-URGENT', '2-HIGH', '5-LOW') group by 1""",
    "quality_relationship": """
        select o_orderkey, o_custkey from orders where not exists (
          select 1 from customer where c_custkey = o_custkey and c_acctbal > 0)""",
    "quality_expression": """
        select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount from lineitem
        where l_discount < 0.01 or l_discount > 0.09""",
    "quality_freshness": """
        select last_date, cast(age as int) as age_days,
               case when age > 180 then 'error' when age > 90 then 'warn' else 'pass' end as status
        from (select max(cast(o_orderdate as date)) as last_date,
                     date '2001-12-01' - max(cast(o_orderdate as date)) as age from orders)""",
    "quality_row_counts": " union all ".join(
        f"select '{t}' as table_name, count(*) as n from {t}"
        for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    ),
    "quality_all_models": _checks(),
    "prices_commune_year": f"""
        select code_commune, annee, nb_ventes, nb_ventes_appartements, nb_ventes_maisons, {_SIX} from prices""",
    "tension_ranking": "select code_commune, nom_commune, code_departement, zone_idf, annee, indice_tension, rang from tension",
}

_stats = []
for _i, _kind in enumerate(("appartement", "maison", "apt_maison", "local")):
    _stats += [
        f"case when p_partkey % {5 + _i} <> 0 then cast(p_size + {_i} as int) end as nb_ventes_{_kind}",
        f"p_retailprice + {_i} as prix_m2_moyen_{_kind}",
        f"case when p_size % 7 <> 0 then p_retailprice end as prix_m2_median_{_kind}",
    ]

MODELS: dict[str, str] = {
    "transit_density": "select * from transit",
    "cycle_density": "select * from cyc",
    "model_sales": "select * from sales",
    "model_sale_stats": f"""
        select 'P' || p_partkey as code_geo, p_name as libelle_geo, p_brand as code_parent, p_type as echelle_geo,
               {', '.join(_stats)} from part where p_partkey % 97 <> 0""",
    "model_communes": "select *, code_region = '11' as is_idf from geo",
    "model_income_stage": "select * from filo",
    "model_population_age": "select * from ages",
    "model_population": "select * from pop",
    "model_crime_total": f"select * replace ({rnd('nb_faits_total', 2)} as nb_faits_total) from crime_rate",
    "model_crime_detail": "select * from det",
    "model_rents": "select * from rents",
    "model_communes_region": "select * exclude (code_commune_parent) from region_geo",
    "model_income": "select * from inc",
    "model_age_structure": "select * from age_mart",
    "accessibility_mart": "select * replace ("
    + ", ".join(f"{single(c) if 'moyen' in c else rnd(c, 6)} as {c}" for c in ("prix_median", "prix_moyen", "prix_m2_median", "prix_m2_moyen"))
    + f", {rnd('nb_faits_delinquance', 2)} as nb_faits_delinquance"
    + ") from acc",
    "zone_rollup": "select * from zones",
    "price_evolution": "select * replace ("
    + ", ".join(f"{rnd(c, 6)} as {c}" for c in ("prix_m2_median", "prix_m2_median_annee_prec"))
    + ") from evo",
    "city_prices_by_rooms": "select * from rooms",
    "model_diplomas": "select * from dip",
}

# --- cards --------------------------------------------------------------------

Y, CRIME_YEAR = PERIODS.latest, PERIODS.crime
_P, _YOUNG, _SENIOR = '"Prix au m² (€)"', '"Part des 25–39 ans (%)"', '"Part des 60 ans et plus (%)"'
_RATE, _SALES, _RATIO = '"Faits pour 1 000 hab."', '"Nombre de ventes"', '"Ratio prix / revenu (années)"'
_CODE, _NAME, _DEP, _YEAR = 'code_commune as "Code commune"', 'nom_commune as "Commune"', 'code_departement as "Département"', 'cast(annee as varchar) as "Année"'
_ZONE, _HIGHER, _NODIP = 'zone_idf as "Zone"', '"Diplômés du supérieur (%)"', '"Sans diplôme (%)"'
_price = f"{rnd('prix_m2_median')} as {_P}"
_young = f"{rnd('part_25_39 * 100', 1)} as {_YOUNG}"
_senior = f"{rnd('part_60_plus * 100', 1)} as {_SENIOR}"
_wprice = f"{rnd(wmean('prix_m2_median', 'nb_ventes'))} as {_P}"
_wyoung = f"{rnd(wmean('part_25_39', 'population_2021') + ' * 100', 1)} as {_YOUNG}"
_facts = f"{rnd(ratio(total('nb_faits_delinquance'), total('population_2021')) + ' * 1000', 1)} as {_RATE}"
_last_crime = "annee = (select max(annee) from acc where taux_delinquance_pour_mille is not null) and taux_delinquance_pour_mille is not null"
_crime_rate = f"{rnd('taux_delinquance_pour_mille', 1)} as {_RATE}"


def _cat(label: str) -> str:
    return (
        f"{category('d.type_delit')} as \"Catégorie\", "
        f"{rnd(ratio(total('d.nb_faits'), total('d.population')) + ' * 1000', 1)} as {label}"
    )


_crime_join = "from det d join acc a on a.code_commune = d.code_commune and a.annee = d.annee"


def _rent(rooms: int) -> str:
    return (
        f"select a.code_commune as \"Code commune\", {rnd('loyer_m2_median * r.surface_mediane')} as \"Loyer mensuel (€)\" "
        f"from acc a join rooms r on a.code_commune = r.code_commune and a.annee = r.annee "
        f"where a.annee = {Y} and nb_pieces = {rooms} and loyer_m2_median is not null"
    )


REGION_CARDS: dict[str, str] = {
    "region_price_by_department": f"select {_DEP}, {_wprice}, cast(sum(nb_ventes) as int) as {_SALES} from acc where annee = {Y} group by code_departement",
    "region_young_by_department": f"select {_DEP}, {_wyoung} from acc where annee = {Y} and part_25_39 is not null group by code_departement",
    "region_zone_table": f"""select {_ZONE}, {_YEAR}, nb_communes as "Nombre de communes", nb_ventes_total as {_SALES},
        {rnd('prix_m2_median_pondere')} as {_P}, {rnd('niveau_vie_median_pondere')} as "Niveau de vie médian (€)",
        {rnd('ratio_achat_revenu_pondere', 1)} as {_RATIO}, {rnd('part_25_39_ponderee * 100', 1)} as {_YOUNG} from zones""",
    "region_price_series": f"select {_YEAR}, {_ZONE}, prix_m2_median_pondere as {_P} from zones",
    "region_sales_series": f"select {_YEAR}, {_ZONE}, nb_ventes_total as {_SALES} from zones",
    "region_price_and_young": f"select {_DEP}, {_wprice}, {_wyoung} from acc where annee = {Y} and part_25_39 is not null group by code_departement",
    "region_ratio_series": f"select {_YEAR}, {_ZONE}, ratio_achat_revenu_pondere as {_RATIO} from zones",
    "region_area_series": f"""select {_YEAR}, {_ZONE}, {dbl(f"round_even({wmean('surface_mediane', 'nb_ventes')}, 0)")} as "Surface médiane (m²)" from acc group by annee, zone_idf""",
    "region_rent_by_department": f"""select {_DEP}, {rnd(wmean('loyer_m2_median', 'nb_ventes'), 1)} as "Loyer au m² (€)" from acc where annee = {Y} and loyer_m2_median is not null group by code_departement""",
    "region_rent_against_purchase": f"""select {_ZONE}, {rnd(wmean('loyer_m2_median', 'nb_ventes'), 1)} as "Loyer au m² (€/mois)",
        {rnd(wmean('prix_m2_median', 'nb_ventes') + ' / 12')} as "Mensualité d'achat au m² (€)" from acc where annee = {Y} and loyer_m2_median is not null group by zone_idf""",
    "region_crime_by_department": f"select {_DEP}, {_facts} from acc where {_last_crime} group by code_departement",
    "region_crime_series": f"select {_YEAR}, {_ZONE}, {_facts} from acc where taux_delinquance_pour_mille is not null group by annee, zone_idf",
    "region_crime_by_category": f"select {_cat(_RATE)} {_crime_join} where d.annee = {CRIME_YEAR} and zone_idf is not null group by 1",
    "region_category_series": f"select cast(d.annee as varchar) as \"Année\", {_cat('taux')} {_crime_join} where zone_idf is not null group by 1, 2",
    "region_senior_by_department": f"select {_DEP}, {rnd(wmean('part_60_plus', 'population_2021') + ' * 100', 1)} as {_SENIOR} from acc where annee = {Y} and part_60_plus is not null group by code_departement",
    "region_higher_education": f"select {_DEP}, {rnd(wmean('part_etudes_sup', 'pop_15p_non_scol'), 1)} as {_HIGHER} from acc join dip using (code_commune) where annee = {Y} group by code_departement",
    "region_no_diploma": f"select {_DEP}, {rnd(wmean('part_sans_diplome', 'pop_15p_non_scol'), 1)} as {_NODIP} from acc join dip using (code_commune) where annee = {Y} group by code_departement",
}

_city = f"annee = {Y} and code_commune like '751%'"
CITY_CARDS: dict[str, str] = {
    "city_price": f"select {_CODE}, {_price} from acc where {_city}",
    "city_young": f"select {_CODE}, {_young} from acc where {_city}",
    "city_price_series": f"select {_YEAR}, {_NAME}, {_price} from evo where code_commune like '751%'",
    "city_detail": f"""select {_NAME}, {_price}, nb_ventes as {_SALES}, {_young}, {rnd('niveau_vie_median')} as "Revenu médian (€)",
        {rnd('surface_mediane', 1)} as "Surface médiane (m²)" from acc where {_city}""",
    "city_area": f"""select {_NAME}, {rnd('surface_mediane', 1)} as "Surface médiane (m²)", nb_ventes as {_SALES} from acc where {_city}""",
    "city_studio_rent": _rent(1),
    "city_two_room_rent": _rent(2),
    "city_crime": f"select {_CODE}, {_crime_rate} from acc where {_last_crime} and code_commune like '751%'",
    "city_crime_by_category": f"select cast(right(d.code_commune, 2) as int) as \"Arrondissement\", {_cat(_RATE)} from det d where annee = {CRIME_YEAR} and code_commune like '751%' group by 1, 2",
    "city_cycle_paths": f"select {_CODE}, km_par_km2 as \"Pistes cyclables (km/km²)\" from cyc",
    "city_transit": f"select {_CODE}, stations_par_km2 as \"Stations par km²\", nb_lignes_uniques as \"Lignes desservies\" from transit where code_commune like '751%'",
    "city_senior": f"select {_CODE}, {_senior} from acc where {_city} and part_60_plus is not null",
    "city_higher_education": f"select {_CODE}, part_etudes_sup as {_HIGHER} from acc join dip using (code_commune) where {_city}",
    "city_no_diploma": f"select {_CODE}, part_sans_diplome as {_NODIP} from acc join dip using (code_commune) where {_city}",
    "city_price_and_young": f"select {_NAME}, {_price}, {_young} from acc where {_city} and part_25_39 is not null",
}


def ring_cards(include_city: bool) -> dict[str, str]:
    deps = "('92', '93', '94', '75')" if include_city else "('92', '93', '94')"
    scope = f"code_departement in {deps}"
    codes = "left(code_commune, 2) in ('92', '93', '94')" + (" or code_commune like '751%'" if include_city else "")
    last = f"annee = {Y} and {scope}"
    return {
        "ring_price": f"select {_CODE}, {_price} from acc where {last}",
        "ring_young": f"select {_CODE}, {_young} from acc where {last}",
        "ring_price_series": f"""select {_YEAR}, {_NAME}, {_price} from evo where {scope} and code_commune in (
            select code_commune from acc where {last} order by nb_ventes desc, code_commune limit 10)""",
        "ring_largest": f"""select {_NAME}, {_DEP}, {_price}, nb_ventes as {_SALES}, {_young},
            {rnd('niveau_vie_median')} as "Revenu médian (€)", {rnd('ratio_achat_revenu_annuel', 1)} as {_RATIO}
            from acc where {last} order by nb_ventes desc, code_commune limit 20""",
        "ring_rent": f"""select {_CODE}, {rnd('loyer_m2_median', 1)} as "Loyer au m² (€)" from acc where {last} and loyer_m2_median is not null""",
        "ring_crime": f"select {_CODE}, {_crime_rate} from acc where {_last_crime} and {scope}",
        "ring_crime_by_category": f"select {_cat(_RATE)} {_crime_join} where d.annee = {CRIME_YEAR} and {scope} group by 1",
        "ring_transit": f"select {_CODE}, stations_par_km2 as \"Stations par km²\" from transit where {codes}",
        "ring_senior": f"select {_CODE}, {_senior} from acc where {last} and part_60_plus is not null",
        "ring_higher_education": f"select {_CODE}, part_etudes_sup as {_HIGHER} from acc join dip using (code_commune) where {last}",
        "ring_no_diploma": f"select {_CODE}, part_sans_diplome as {_NODIP} from acc join dip using (code_commune) where {last}",
        "ring_price_and_young": f"select {_NAME}, {_DEP}, {_price}, {_young} from acc where {last} and part_25_39 is not null",
    }


def all_oracles() -> dict[str, str]:
    queries = OPERATORS | MODELS
    for name, sql in {**REGION_CARDS, **CITY_CARDS, **ring_cards(False)}.items():
        queries[f"serving_{name}"] = sql
    for name, sql in ring_cards(True).items():
        queries[f"serving_{name}_with_city"] = sql
    return {name: CTES + sql.lstrip() for name, sql in queries.items()}
