"""Query registry: name -> Spark query over a driver data directory, plus oracle SQL.

Every query reads whole driver tables (or the profile fixture Spark derives
from the whole ``part`` table). ``ORACLE`` holds DuckDB SQL for the same
result over views named like the driver tables.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitlens import constants as K
from traitlens.operators.filters import Filters
from traitlens.plans import oracle as O
from traitlens.plans import reports as R
from traitlens.plans import star as S
from traitlens.session import BASE_CONF, checkpoint_dir
from traitlens.sources.fixture import raw_profiles
from traitlens.sources.tables import table

# Fixed "as of" instant for freshness and quality reports: results must not
# depend on the wall clock.
AS_OF = _dt.datetime(2026, 1, 1, 0, 0, 0)
AS_OF_SQL = "timestamp '2026-01-01 00:00:00'"

# Dashboard selections used by the registered dashboard queries.
LONGEST_LIVED_FILTERS = Filters(groups=("Toy", "Sporting", "Hound"), weight_range=(2.0, 40.0))
TOP_TRAITS_FILTERS = Filters(sizes=("Very Small", "Small", "Medium"),
                             suitability=("Good for Families", "Moderate for Families"))


class Inputs:
    """Lazy inputs of one registry run."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    @cached_property
    def raw(self) -> DataFrame:
        return raw_profiles(self.spark, self.sf_dir)

    @cached_property
    def stg(self) -> DataFrame:
        return S.stage(self.raw)

    def frame(self, *columns: str, fct_columns: dict[str, str] | None = None) -> DataFrame:
        """The given columns of the star, as narrow as they allow."""
        return S.frame(self.raw, columns, fct_columns)

    @cached_property
    def profiles(self) -> DataFrame:
        return S.profile_frame(self.stg)

    @cached_property
    def fct(self) -> DataFrame:
        return S.fct_metrics(self.stg)

    @cached_property
    def dim(self) -> DataFrame:
        return S.dim_profiles(self.stg)

    @cached_property
    def traits(self) -> DataFrame:
        return S.dim_traits(S.stage(self.raw, measures=False))


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """Lazy inputs of one call: tables are listed anew each time, so a rewritten one is seen."""
    # Load stamps and "as of" instants are UTC wall-clock values; wide stages must stay compilable.
    for key in ("spark.sql.session.timeZone", "spark.sql.codegen.hugeMethodLimit"):
        if spark.conf.get(key) != BASE_CONF[key]:
            spark.conf.set(key, BASE_CONF[key])
    return Inputs(spark, sf_dir)


def register(name: str, oracle: str | None = None):
    def deco(fn: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: fn(inputs(spark, sf_dir))
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


# Oracle building blocks ------------------------------------------------------
_PROFILES = """,
prof as (
  select d.*, t.* exclude (breed_id, breed_name, temperament_raw)
  from dim d join traits t using (breed_id)
)"""

_BOUNDS = """,
b0 as (select cast(min(avg_weight_kg) as double) as lo, cast(max(avg_weight_kg) as double) as hi
       from prof where avg_weight_kg is not null),
b1 as (select least(coalesce(lo, 0.0), coalesce(hi, 100.0)) as lo,
              greatest(coalesce(lo, 0.0), coalesce(hi, 100.0)) as hi from b0),
bounds as (select case when lo = hi then greatest(0.0, lo - 1.0) else lo end as min_w,
                  case when lo = hi then hi + 1.0 else hi end as max_w from b1)"""


def _with(body: str, extra: str = "", nan: str = "null") -> str:
    return f"with {O.star_ctes(nan)}{extra}\n{body}"


def _in(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _filters_sql(f: Filters, alias: str = "prof") -> str:
    preds = []
    if f.groups:
        preds.append(f"breed_group in ({_in(f.groups)})")
    if f.sizes:
        preds.append(f"size_category in ({_in(f.sizes)})")
    if f.weight_range is None:
        preds.append("avg_weight_kg between (select min_w from bounds) and (select max_w from bounds)")
    else:
        preds.append(f"avg_weight_kg between {float(f.weight_range[0])} and {float(f.weight_range[1])}")
    return " and ".join(preds)


# Star ------------------------------------------------------------------------
@register("stg_profiles", _with("select * from stg"))
def stg_profiles(i: Inputs) -> DataFrame:
    return i.stg


@register("range_parse_literal_nan", _with(
    "select breed_id, weight_min_kg, weight_max_kg, weight_min_lbs, weight_max_lbs from stg", nan="propagate"))
def range_parse_literal_nan(i: Inputs) -> DataFrame:
    return (S.stage(i.raw, nan="propagate")
            .select("breed_id", "weight_min_kg", "weight_max_kg", "weight_min_lbs", "weight_max_lbs"))


@register("dim_profiles", _with("select * from dim"))
def dim_profiles(i: Inputs) -> DataFrame:
    return i.dim


@register("fct_metrics", _with("select * from fct"))
def fct_metrics(i: Inputs) -> DataFrame:
    return i.fct


@register("dim_traits", _with("select * from traits"))
def dim_traits(i: Inputs) -> DataFrame:
    return i.traits


# Dashboard -------------------------------------------------------------------
@register("size_distribution", _with(
    f"select size_category, count(*) as breed_count from prof where {_filters_sql(Filters())}"
    " group by size_category", _PROFILES + _BOUNDS))
def size_distribution(i: Inputs) -> DataFrame:
    return R.size_distribution(i.frame("breed_group", "size_category", "avg_weight_kg"), Filters())


@register("longest_lived", _with(
    f"select breed_name, avg_life_span_years from prof where {_filters_sql(LONGEST_LIVED_FILTERS)}"
    " and avg_life_span_years is not null order by avg_life_span_years desc, breed_name limit 10",
    _PROFILES))
def longest_lived(i: Inputs) -> DataFrame:
    return R.longest_lived(i.frame("breed_group", "size_category", "avg_weight_kg", "breed_name",
                                   "avg_life_span_years"), LONGEST_LIVED_FILTERS)


@register("top_traits", _with(
    f"""select lower(trim(u.trait)) as temperament_trait, count(*) as occurrences
from prof, unnest(prof.trait_array) as u(trait)
where {_filters_sql(TOP_TRAITS_FILTERS)} and family_suitability in ({_in(TOP_TRAITS_FILTERS.suitability)})
  and total_traits > 0
group by 1 order by occurrences desc, temperament_trait limit 15""", _PROFILES + _BOUNDS))
def top_traits(i: Inputs) -> DataFrame:
    return R.top_traits(i.frame("breed_group", "size_category", "avg_weight_kg", "family_suitability",
                                "total_traits", "trait_array"), TOP_TRAITS_FILTERS)


@register("top_traits_stored", ORACLE["top_traits"])
def top_traits_stored(i: Inputs) -> DataFrame:
    return R.top_traits_stored(i.frame("breed_id", "breed_group", "size_category", "avg_weight_kg"),
                               i.frame("breed_id", "family_suitability", "total_traits", "trait_array"),
                               TOP_TRAITS_FILTERS)


# Analyses --------------------------------------------------------------------
def _top_names_sql(src: str, group: str, order: str, k: int, alias: str) -> str:
    return f"""
select {group}, string_agg(breed_name, ', ' order by rk) as {alias}
from (select {group}, breed_name, row_number() over (partition by {group} order by {order}) as rk from {src})
where rk <= {k} group by {group}"""


@register("family_by_size", _with(f"""
select 'Family-Friendly Breeds by Size' as analysis_type, s.size_category, s.breed_count,
       s.avg_family_score, n.top_breeds
from (select size_category, count(*) as breed_count, round(avg(family_friendliness_score), 2) as avg_family_score
      from fam group by size_category) s
join ({_top_names_sql('fam', 'size_category', 'family_friendliness_score desc, breed_name', 3, 'top_breeds')}) n
  on s.size_category is not distinct from n.size_category""",
    _PROFILES + ",\nfam as (select * from prof where family_suitability in "
                "('Excellent for Families', 'Good for Families'))"))
def family_by_size(i: Inputs) -> DataFrame:
    return R.family_by_size(i.frame("breed_name", "size_category", "family_suitability", "family_friendliness_score"))


@register("longevity_by_group", _with("""
select 'Longevity by Breed Group' as analysis_type, breed_group, count(*) as breed_count,
       round(avg(avg_life_span_years), 1) as avg_lifespan, min(avg_life_span_years) as min_lifespan,
       max(avg_life_span_years) as max_lifespan
from dim where avg_life_span_years is not null group by breed_group"""))
def longevity_by_group(i: Inputs) -> DataFrame:
    return R.longevity_by_group(i.frame("breed_group", "avg_life_span_years"))


@register("training_scores", _with(f"""
select 'Training Analysis' as analysis_type, s.training_difficulty, s.breed_count,
       s.avg_intelligence_score, s.avg_independence_score, n.example_breeds
from (select training_difficulty, count(*) as breed_count,
             round(avg(intelligence_score), 2) as avg_intelligence_score,
             round(avg(independent_score), 2) as avg_independence_score
      from traits group by training_difficulty) s
join ({_top_names_sql('traits', 'training_difficulty', 'intelligence_score desc, breed_name', 2, 'example_breeds')}) n
  using (training_difficulty)"""))
def training_scores(i: Inputs) -> DataFrame:
    return R.training_scores(i.frame("breed_name", "training_difficulty", "intelligence_score", "independent_score"))


@register("build_stats", _with("""
select 'Physical Characteristics' as analysis_type, build_type, count(*) as breed_count,
       round(avg(avg_weight_lbs), 1) as avg_weight_lbs, round(avg(avg_height_inches), 1) as avg_height_inches,
       round(avg(weight_height_ratio_imperial), 2) as avg_weight_height_ratio
from fct where build_type is not null group by build_type"""))
def build_stats(i: Inputs) -> DataFrame:
    return R.build_stats(i.fct)


@register("complexity_mode", _with("""
select 'Temperament Complexity' as analysis_type, s.temperament_complexity, s.breed_count, s.avg_traits,
       s.avg_total_score, m.most_common_category
from (select temperament_complexity, count(*) as breed_count, round(avg(total_traits), 1) as avg_traits,
             round(avg(social_score + energy_score + intelligence_score + protective_score
                       + independent_score + calm_score), 2) as avg_total_score
      from traits group by temperament_complexity) s
join (select temperament_complexity, primary_temperament_category as most_common_category
      from (select temperament_complexity, primary_temperament_category,
                   row_number() over (partition by temperament_complexity
                                      order by count(*) desc, primary_temperament_category) as rk
            from traits group by temperament_complexity, primary_temperament_category)
      where rk = 1) m using (temperament_complexity)"""))
def complexity_mode(i: Inputs) -> DataFrame:
    return R.complexity_mode(i.frame("temperament_complexity", "total_traits", "primary_temperament_category",
                                     *R.SCORE_SUM))


@register("quality_summary", _with("""
select 'Data Quality Summary' as analysis_type, 'Overall' as category, count(*) as total_breeds,
       cast(count_if(has_weight_data) as bigint) as breeds_with_weight,
       cast(count_if(has_height_data) as bigint) as breeds_with_height,
       cast(count_if(has_lifespan_data) as bigint) as breeds_with_lifespan,
       cast(count_if(has_temperament_data) as bigint) as breeds_with_temperament,
       round(avg(data_completeness_score), 2) as avg_completeness_score
from dim"""))
def quality_summary(i: Inputs) -> DataFrame:
    return R.quality_summary(i.frame("has_weight_data", "has_height_data", "has_lifespan_data", "has_temperament_data",
                                     "data_completeness_score"))


# Documented queries ------------------------------------------------------------
@register("family_search", _with("""
select breed_name, size_category, avg_life_span_years, family_suitability
from prof where size_category = 'Small' and family_suitability = 'Excellent for Families'""", _PROFILES))
def family_search(i: Inputs) -> DataFrame:
    return R.family_search(i.frame("breed_name", "size_category", "avg_life_span_years", "family_suitability"))


@register("family_search_light", _with("""
select breed_name, avg_weight_lbs, size_category, avg_life_span_years, family_friendliness_score,
       training_difficulty, primary_temperament_category
from prof where avg_weight_lbs <= 50 and family_suitability = 'Excellent for Families'""", _PROFILES))
def family_search_light(i: Inputs) -> DataFrame:
    return R.family_search_light(i.frame(
        "breed_name", "avg_weight_lbs", "size_category", "avg_life_span_years", "family_suitability",
        "family_friendliness_score", "training_difficulty", "primary_temperament_category"))


@register("build_averages", _with("""
select build_type, count(*) as breed_count, round(avg(avg_weight_lbs), 6) as avg_weight,
       round(avg(avg_height_inches), 6) as avg_height, round(avg(avg_life_span_years), 6) as avg_lifespan
from fct where build_type is not null group by build_type"""))
def build_averages(i: Inputs) -> DataFrame:
    return R.build_averages(i.fct)


@register("complexity_by_group", _with("""
select breed_group, round(avg(total_traits), 6) as avg_temperament_complexity,
       round(avg(intelligence_score), 6) as avg_intelligence,
       round(avg(family_friendliness_score), 6) as avg_family_score, count(*) as breed_count
from prof where has_temperament_data group by breed_group""", _PROFILES))
def complexity_by_group(i: Inputs) -> DataFrame:
    return R.complexity_by_group(i.frame("breed_group", "has_temperament_data", "total_traits", "intelligence_score",
                                         "family_friendliness_score"))


# Facets ----------------------------------------------------------------------
@register("facet_values", _with("""
select 'breed_group' as facet, breed_group as value from prof where breed_group is not null and breed_group <> ''
union select 'size_category', size_category from prof where size_category is not null and size_category <> ''
union select 'family_suitability', family_suitability from prof
  where family_suitability is not null and family_suitability <> ''""", _PROFILES))
def facet_values(i: Inputs) -> DataFrame:
    return R.facet_values(i.frame(*R.FACETS))


@register("facet_bounds", _with("select min_w, max_w from bounds", _PROFILES + _BOUNDS))
def facet_bounds(i: Inputs) -> DataFrame:
    return R.facet_bounds(i.frame("avg_weight_kg"))


# Quality ---------------------------------------------------------------------
from traitlens.operators import quality as Q  # noqa: E402
from traitlens.plans import quality_rules as QR  # noqa: E402

_SQL_TABLE = {"stg_profiles": "stg", "dim_profiles": "dim", "fct_metrics": "fct", "dim_traits": "traits"}


def _star_keys(i: Inputs) -> dict[str, DataFrame]:
    """The models' keys and names; none of them needs a range or a trait list."""
    keys = i.frame("breed_id", "breed_name")
    return {"stg_profiles": keys, "dim_profiles": keys, "fct_metrics": keys, "dim_traits": keys}


def _rule_tables(i: Inputs, rules: list[Q.Rule]) -> dict[str, DataFrame]:
    """Model name -> frame of the columns its rules read: staging, dimension and fact share one scan, traits another."""
    def of(*models: str) -> DataFrame:
        words = dict.fromkeys(c for r in rules if r.table in models for c in r.columns)
        return i.frame(*dict.fromkeys(["breed_id", "breed_name", *(w for w in words if S.is_column(w))]))

    star = of("stg_profiles", "dim_profiles", "fct_metrics")
    return {"stg_profiles": star, "dim_profiles": star, "fct_metrics": star, "dim_traits": of("dim_traits")}


def _violation_sql(r: Q.Rule) -> str:
    c = r.column
    if r.kind == "not_null":
        return f"{c} is null"
    if r.kind == "accepted_values":
        return f"{c} is not null and {c} not in ({_in(r.values)})"
    if r.kind == "accepted_range":
        return f"{c} is not null and not ({c} between {r.low} and {r.high})"
    if r.kind == "expression_is_true":
        return f"coalesce(not ({r.expression}), false)"
    raise ValueError(r.kind)


def _unique_sql(r: Q.Rule, table: str) -> str:
    return (f"select '{r.name}' as test_name, cast({r.column} as varchar) as value, count(*) as n_rows "
            f"from {table} where {r.column} is not null group by {r.column} having count(*) > 1")


def _orphans_sql(r: Q.Rule, child: str, parent: str) -> str:
    return (f"select '{r.name}' as test_name, cast({r.column} as bigint) as child_key, count(*) as n_rows "
            f"from {child} c where {r.column} is not null and not exists "
            f"(select 1 from {parent} p where p.{r.parent_column} = c.{r.column}) group by {r.column}")


def _rules(kind: str) -> list[Q.Rule]:
    return [r for r in QR.star_rules() if r.kind == kind]


def _failing_rows_query(kind: str):
    def run(i: Inputs) -> DataFrame:
        # the models are 1:1 projections of staging: one scan per frame, not per model
        rules = _rules(kind)
        parts = [Q.failing_rows_all(df, rs, "breed_id") for df, rs in Q.by_frame(_rule_tables(i, rules), rules)]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out
    return run


def _failing_rows_sql(kind: str) -> str:
    selects = []
    for r in _rules(kind):
        value = "cast(null as varchar)" if kind == "expression_is_true" else f"cast({r.column} as varchar)"
        selects.append(f"select '{r.name}' as test_name, cast(breed_id as bigint) as row_key, {value} as value "
                       f"from {_SQL_TABLE[r.table]} where {_violation_sql(r)}")
    return _with("\nunion all\n".join(selects))


for _kind, _qname in (("not_null", "dq_not_null"), ("accepted_values", "dq_values"),
                      ("accepted_range", "dq_range"), ("expression_is_true", "dq_expr")):
    if _kind in ("accepted_range", "expression_is_true"):
        register(_qname, _failing_rows_sql(_kind))(_failing_rows_query(_kind))

#: Rules on driver tables that have failing rows: documents outside two languages, documents without a label.
_LANG_RULE = Q.accepted_values("documents", "lang", ("en", "de"))
_LABEL_RULE = Q.not_null("documents_labels", "quality")
_LABELLED = "(select documents.doc_id, quality from documents left join labels on labels.doc_id = documents.doc_id)"


def _native_failing_sql(kind: str, r: Q.Rule, table: str) -> str:
    return _failing_rows_sql(kind) + f"""
union all select '{r.name}', cast(doc_id as bigint), cast({r.column} as varchar) from {table} x
where {_violation_sql(r)}"""


@register("dq_values", _native_failing_sql("accepted_values", _LANG_RULE, "documents"))
def dq_values(i: Inputs) -> DataFrame:
    return _failing_rows_query("accepted_values")(i).unionByName(
        Q.failing_rows(i.table("documents"), _LANG_RULE, "doc_id"))


@register("dq_not_null", _native_failing_sql("not_null", _LABEL_RULE, _LABELLED))
def dq_not_null(i: Inputs) -> DataFrame:
    labelled = i.table("documents").select("doc_id").join(i.table("labels").select("doc_id", "quality"), "doc_id", "left")
    return _failing_rows_query("not_null")(i).unionByName(Q.failing_rows(labelled, _LABEL_RULE, "doc_id"))


_PART_NAME_RULE = Q.unique("part", "p_name")


@register("dq_unique", _with("\nunion all\n".join(
    [_unique_sql(r, _SQL_TABLE[r.table]) for r in _rules("unique")] + [_unique_sql(_PART_NAME_RULE, "part")])))
def dq_unique(i: Inputs) -> DataFrame:
    out = Q.duplicate_keys(i.table("part"), _PART_NAME_RULE)
    rules = _rules("unique")
    return out.unionByName(Q.duplicate_keys_all(_rule_tables(i, rules)["stg_profiles"], rules))


_NATIVE_RELATIONSHIPS = (
    Q.relationships("lineitem", "l_orderkey", "orders", "o_orderkey"),
    Q.relationships("lineitem", "l_partkey", "part", "p_partkey"),
    Q.relationships("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    Q.relationships("orders", "o_custkey", "customer", "c_custkey"),
    Q.relationships("documents", "doc_id", "labels", "doc_id"),
)


@register("dq_relationships", _with("\nunion all\n".join(
    [_orphans_sql(r, _SQL_TABLE[r.table], _SQL_TABLE[r.parent]) for r in _rules("relationships")]
    + [_orphans_sql(r, r.table, r.parent) for r in _NATIVE_RELATIONSHIPS])))
def dq_relationships(i: Inputs) -> DataFrame:
    tables = _star_keys(i)
    out = None
    for r in _rules("relationships"):
        part = Q.orphan_keys(tables[r.table], tables[r.parent], r)
        out = part if out is None else out.unionByName(part)
    for r in _NATIVE_RELATIONSHIPS:
        out = out.unionByName(Q.orphan_keys(i.table(r.table), i.table(r.parent), r))
    return out


def _summary_sql() -> str:
    parts = []
    for r in QR.star_rules():
        t = _SQL_TABLE[r.table]
        head = f"select '{r.table}' as table_name, '{r.name}' as test_name, '{r.kind}' as kind, '{r.severity}' as severity"
        if r.kind in Q.ROW_KINDS:
            parts.append(f"{head}, cast(count_if({_violation_sql(r)}) as bigint) as failures from {t}")
        elif r.kind == "unique":
            parts.append(f"{head}, cast(coalesce(sum(n_rows), 0) as bigint) as failures from ({_unique_sql(r, t)})")
        else:
            parts.append(f"{head}, cast(coalesce(sum(n_rows), 0) as bigint) as failures "
                         f"from ({_orphans_sql(r, t, _SQL_TABLE[r.parent])})")
    body = "\nunion all\n".join(parts)
    return _with(f"""select *, case when failures = 0 then 'pass' when severity = 'error' then 'fail'
  else 'warn' end as status from ({body})""")


@register("dq_summary", _summary_sql())
def dq_summary(i: Inputs) -> DataFrame:
    rules = QR.star_rules()
    return Q.summarize(_rule_tables(i, rules), rules)


@register("dq_recency", _with(f"""
select test_name, newest, threshold, coalesce(newest >= threshold, false) as passed from (
  select 'recency__raw__extracted_at' as test_name, cast(max(extracted_at) as timestamp) as newest,
         {AS_OF_SQL} - interval 7 day as threshold from raw
  union all
  select 'recency__events__ts', cast(max(ts) as timestamp), {AS_OF_SQL} - interval 7 day from events
  union all
  select 'recency__events__ts__feb_2024', cast(max(ts) as timestamp), timestamp '2024-01-25 00:00:00' from events
  union all
  select 'recency__orders__o_orderdate', cast(max(o_orderdate) as timestamp), {AS_OF_SQL} - interval 7 day
  from orders)"""))
def dq_recency(i: Inputs) -> DataFrame:
    days = K.RECENCY_DAYS
    return (Q.recency(i.raw, "extracted_at", AS_OF, days, "recency__raw__extracted_at")
            .unionByName(Q.recency(i.table("events"), "ts", AS_OF, days, "recency__events__ts"))
            .unionByName(Q.recency(i.table("events"), "ts", _dt.datetime(2024, 2, 1), days,
                                   "recency__events__ts__feb_2024"))
            .unionByName(Q.recency(i.table("orders"), "o_orderdate", AS_OF, days,
                                   "recency__orders__o_orderdate")))


def _consistency_sql(dim: str, others: list[str], key: str, label: str, other_labels: bool) -> str:
    parts = []
    for o in others:
        parts.append(f"select '{o}' as issue_type, d.{key}, d.{label}, 'missing_breed' as issue_description "
                     f"from {dim} d where not exists (select 1 from {o} x where x.{key} = d.{key})")
    for o in others:
        lab = f"x.{label}" if other_labels else "cast(null as varchar)"
        parts.append(f"select '{o}' as issue_type, x.{key}, {lab} as {label}, 'orphaned_record' "
                     f"from {o} x where not exists (select 1 from {dim} d where d.{key} = x.{key})")
    return "\nunion all\n".join(parts)


def _both_ways_sql() -> str:
    """Documents without a label, seen from the documents and from the labels."""
    return (_consistency_sql("documents", ["labels"], "doc_id", "source", False)
            + "\nunion all\n"
            + "select 'documents', x.doc_id, x.source, 'orphaned_record' from documents x "
              "where not exists (select 1 from labels d where d.doc_id = x.doc_id)")


@register("dq_star", _with(
    "select issue_type, cast(breed_id as bigint) as record_key, breed_name as record_label, issue_description from ("
    + _consistency_sql("dim", ["fct", "traits"], "breed_id", "breed_name", True).replace("'fct'", "'fct_metrics'")
    .replace("'traits'", "'dim_traits'") + ")\nunion all\n"
    + "select issue_type, doc_id, source, issue_description from (" + _both_ways_sql() + ")"))
def dq_star(i: Inputs) -> DataFrame:
    """The star's marts (which agree), and documents against labels both ways (which do not)."""
    t = _star_keys(i)
    docs, labels = i.table("documents").select("doc_id", "source"), i.table("labels").select("doc_id")
    star = Q.star_consistency(t["dim_profiles"], {"fct_metrics": t["fct_metrics"], "dim_traits": t["dim_traits"]},
                              "breed_id", "breed_name")
    missing = Q.star_consistency(docs, {"labels": labels}, "doc_id", "source")
    orphaned = Q.star_consistency(labels.withColumn("source", F.lit(None).cast("string")), {"documents": docs},
                                  "doc_id", "source")
    names = ("issue_type", "record_key", "record_label", "issue_description")
    return star.toDF(*names).unionByName(missing.toDF(*names)).unionByName(orphaned.toDF(*names))


@register("dq_label_coverage", "with x as (select 1)\n"
          + _consistency_sql("documents", ["labels"], "doc_id", "source", False))
def dq_label_coverage(i: Inputs) -> DataFrame:
    return Q.star_consistency(i.table("documents"), {"labels": i.table("labels")}, "doc_id", "source")


@register("dq_row_counts", _with("""
select 'stg_profiles' as table_name, count(*) as row_count from stg
union all select 'dim_profiles', count(*) from dim
union all select 'fct_metrics', count(*) from fct
union all select 'dim_traits', count(*) from traits"""))
def dq_row_counts(i: Inputs) -> DataFrame:
    return Q.row_counts(_star_keys(i))


# Native tables -----------------------------------------------------------------
@register("quantity_range_roundtrip", """
with r as (select l_partkey, min(l_quantity) as lo, max(l_quantity) as hi, count(*) as n_lines
           from lineitem group by l_partkey),
t as (select l_partkey, lo, hi, n_lines,
             cast(lo as varchar) || ' - ' || cast(hi as varchar) as quantity_range from r)
select l_partkey, quantity_range, n_lines,
       try_cast(trim(string_split(quantity_range, ' - ')[1]) as double) as parsed_low,
       try_cast(trim(string_split(quantity_range, ' - ')[2]) as double) as parsed_high,
       coalesce(try_cast(trim(string_split(quantity_range, ' - ')[1]) as double) = lo
                and try_cast(trim(string_split(quantity_range, ' - ')[2]) as double) = hi, false) as roundtrip_ok
from t""")
def quantity_range_roundtrip(i: Inputs) -> DataFrame:
    from traitlens.functions.ranges import parse_range
    r = (i.table("lineitem").groupBy("l_partkey")
         .agg(F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"),
              F.count(F.lit(1)).alias("n_lines"))
         .withColumn("quantity_range", F.concat_ws(" - ", F.col("lo").cast("string"), F.col("hi").cast("string"))))
    low, high = parse_range(F.col("quantity_range"))
    return r.select("l_partkey", "quantity_range", "n_lines", low.alias("parsed_low"), high.alias("parsed_high"),
                    F.coalesce((low == F.col("lo")) & (high == F.col("hi")), F.lit(False)).alias("roundtrip_ok"))


EVENT_LEXICONS = {"engagement": ("view", "click"), "conversion": ("signup", "purchase"), "friction": ("error",)}


@register("user_event_shares", "select user_id, count(event_type) as total_events, "
          + ", ".join(f"cast(count_if(lower(trim(event_type)) in ({_in(v)})) as bigint) as {k}_count"
                      for k, v in EVENT_LEXICONS.items()) + ", "
          + ", ".join(f"cast(case when count(event_type) > 0 then count_if(lower(trim(event_type)) in ({_in(v)}))"
                      f" / count(event_type) else 0 end as double) as {k}_share" for k, v in EVENT_LEXICONS.items())
          + " from events where event_type is not null and trim(event_type) <> '' group by user_id")
def user_event_shares(i: Inputs) -> DataFrame:
    from traitlens.operators.traits import lexicon_counts, lexicon_shares
    # events already arrive one item per row: the explode form without the explode
    ev = i.table("events").select("user_id", F.col("event_type"))
    items = (ev.where(F.col("event_type").isNotNull())
             .select("user_id", F.trim("event_type").alias("item")).where(F.col("item") != ""))
    counts = lexicon_counts(items, ["user_id"], "item", EVENT_LEXICONS,
                            {k: f"{k}_count" for k in EVENT_LEXICONS}, total="total_events")
    return lexicon_shares(counts, EVENT_LEXICONS, {k: f"{k}_count" for k in EVENT_LEXICONS},
                          {k: f"{k}_share" for k in EVENT_LEXICONS}, total="total_events")


@register("user_modal_event", """
select user_id, event_type as modal_event_type from (
  select user_id, event_type, row_number() over (partition by user_id order by count(*) desc, event_type) as rk
  from events where event_type is not null group by user_id, event_type) where rk = 1""")
def user_modal_event(i: Inputs) -> DataFrame:
    from traitlens.operators.aggregates import modal_value
    return modal_value(i.table("events"), "user_id", "event_type", "modal_event_type")


@register("order_value_by_priority", """
select o_orderpriority, count(*) as order_count, round(avg(o_totalprice), 2) as avg_totalprice,
       min(o_totalprice) as min_totalprice, max(o_totalprice) as max_totalprice,
       round(sum(o_totalprice), 2) as sum_totalprice
from orders group by o_orderpriority""")
def order_value_by_priority(i: Inputs) -> DataFrame:
    return (i.table("orders").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("order_count"), F.round(F.avg("o_totalprice"), 2).alias("avg_totalprice"),
        F.min("o_totalprice").alias("min_totalprice"), F.max("o_totalprice").alias("max_totalprice"),
        F.round(F.sum("o_totalprice"), 2).alias("sum_totalprice")))


@register("top_suppliers_by_nation", """
with sn as (select s.*, n.n_name from supplier s join nation n on s.s_nationkey = n.n_nationkey),
st as (select n_name, count(*) as supplier_count, round(avg(s_acctbal), 2) as avg_acctbal from sn group by n_name),
tn as (select n_name, string_agg(s_name, ', ' order by rk) as top_suppliers from (
         select n_name, s_name, row_number() over (partition by n_name order by s_acctbal desc, s_name) as rk from sn)
       where rk <= 3 group by n_name)
select st.n_name, supplier_count, avg_acctbal, top_suppliers from st join tn using (n_name)""")
def top_suppliers_by_nation(i: Inputs) -> DataFrame:
    from traitlens.operators.aggregates import ordered_names
    from traitlens.operators.joins import dimension_join
    # TPC-H fixes nation at 25 rows: a bound by construction.
    sn = dimension_join(i.table("supplier"), i.table("nation").select("n_nationkey", "n_name"),
                        F.col("s_nationkey") == F.col("n_nationkey"), bounded_rows=25)
    stats = sn.groupBy("n_name").agg(F.count(F.lit(1)).alias("supplier_count"),
                                     F.round(F.avg("s_acctbal"), 2).alias("avg_acctbal"))
    names = ordered_names(sn, "n_name", "s_name", [F.desc("s_acctbal"), F.asc("s_name")], 3, "top_suppliers")
    return stats.join(names, "n_name")


# Monitoring --------------------------------------------------------------------
def _fresh_sql(name: str, table: str, col: str) -> str:
    return (f"select '{name}' as model_name, cast(max({col}) as timestamp) as last_update, "
            f"{AS_OF_SQL} as check_timestamp, "
            f"date_diff('hour', date_trunc('hour', cast(max({col}) as timestamp)), date_trunc('hour', {AS_OF_SQL})) "
            f"as hours_since_update from {table}")


_FRESH = (("bronze_raw", "raw", "extracted_at"), ("dim_profiles", "dim", "extracted_at"),
          ("fct_metrics", "fct", "extracted_at"), ("orders", "orders", "o_orderdate"),
          ("lineitem", "lineitem", "l_shipdate"), ("events", "events", "ts"))


@register("freshness", _with("\nunion all\n".join(_fresh_sql(*f) for f in _FRESH)))
def freshness(i: Inputs) -> DataFrame:
    src = {"bronze_raw": (i.raw, "extracted_at"), "dim_profiles": (i.frame("extracted_at"), "extracted_at"),
           "fct_metrics": (i.frame("extracted_at"), "extracted_at"), "orders": (i.table("orders"), "o_orderdate"),
           "lineitem": (i.table("lineitem"), "l_shipdate"), "events": (i.table("events"), "ts")}
    return R.freshness(src, AS_OF)


_DOC_FLAGS = ("(text is not null and trim(text) <> '')", "(lang is not null and trim(lang) <> '')",
              "(source is not null and trim(source) <> '')", "(quality is not null)")


@register("quality_metrics", f"""
with d as (select doc_id, {' + '.join(f'cast({f} as bigint)' for f in _DOC_FLAGS)} as completeness
           from documents left join labels using (doc_id))
select 'Total Documents' as metric, cast(count(*) as double) as value, {AS_OF_SQL} as measured_at from d
union all select 'Documents with Complete Data', cast(count(*) as double), {AS_OF_SQL} from d where completeness = 4
union all select 'Average Data Completeness', cast(round(avg(completeness), 2) as double), {AS_OF_SQL} from d""")
def quality_metrics(i: Inputs) -> DataFrame:
    from traitlens.functions.measures import flag_count
    from traitlens.functions.ranges import is_present
    # Reduce each document to its presence flags BEFORE the join: only keys and
    # booleans cross the shuffle, never the document texts.
    docs = i.table("documents").select(
        "doc_id", flag_count(is_present(F.col("text"), False), is_present(F.col("lang"), False),
                             is_present(F.col("source"), False)).alias("doc_flags"))
    labels = i.table("labels").select("doc_id", "quality")
    d = docs.join(labels, "doc_id", "left").select(
        "doc_id", (F.col("doc_flags") + F.col("quality").isNotNull().cast("bigint")).alias("completeness"))
    return R.metric_report(d, [
        ("Total Documents", F.count(F.lit(1))),
        ("Documents with Complete Data", F.count_if(F.col("completeness") == 4)),
        ("Average Data Completeness", F.round(F.avg("completeness"), 2)),
    ], AS_OF)


@register("loads_per_day", """
select cast(ts as date) as load_date, count(*) as record_count, max(ts) as latest_record
from events group by 1""")
def loads_per_day(i: Inputs) -> DataFrame:
    return R.loads_per_day(i.table("events"), "ts")


@register("latest_snapshot_orders", """
select o.o_orderkey, c.c_name, n.n_name, o.o_totalprice
from orders o join customer c on o.o_custkey = c.c_custkey join nation n on c.c_nationkey = n.n_nationkey
where o.o_orderdate = (select max(o_orderdate) from orders) and c.c_acctbal > 0""")
def latest_snapshot_orders(i: Inputs) -> DataFrame:
    from traitlens.operators.joins import dimension_join, latest_only
    latest = latest_only(i.table("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"),
                         "o_orderdate")
    cust = i.table("customer").where(F.col("c_acctbal") > 0).select("c_custkey", "c_name", "c_nationkey")
    oc = latest.join(cust, F.col("o_custkey") == F.col("c_custkey"))
    ocn = dimension_join(oc, i.table("nation").select("n_nationkey", "n_name"),
                         F.col("c_nationkey") == F.col("n_nationkey"), bounded_rows=25)
    return ocn.select("o_orderkey", "c_name", "n_name", "o_totalprice")


@register("latest_snapshot_profiles", _with("""
select d.breed_name, d.size_category, f.avg_weight_lbs, t.family_suitability
from dim d join fct f using (breed_id) join traits t using (breed_id)
where d.extraction_date = (select max(extraction_date) from dim)
  and f.has_weight_data = true and t.family_suitability = 'Excellent for Families'"""))
def latest_snapshot_profiles(i: Inputs) -> DataFrame:
    from traitlens.operators.joins import latest_only
    wide = i.frame("breed_name", "size_category", "extraction_date", "has_weight_data", "family_suitability",
                   fct_columns={"fct_avg_weight_lbs": "avg_weight_lbs"})
    rows = latest_only(wide, "extraction_date", of=i.raw)
    return (rows.where(F.col("has_weight_data") & (F.col("family_suitability") == "Excellent for Families"))
            .select("breed_name", "size_category", F.col("fct_avg_weight_lbs").alias("avg_weight_lbs"),
                    "family_suitability"))


@register("document_keyword_label", f"""
select doc_id,
  case when text is not null and regexp_matches(lower(text), '{K.FAMILY_PATTERN}') then 'Family-Friendly'
       when text is not null and regexp_matches(lower(text), '{K.GUARD_PATTERN}')
            and not regexp_matches(lower(text), '{K.GUARD_EXCLUDE_PATTERN}') then 'Protective/Guardian'
       when text is not null then 'Moderate' else 'Unknown' end as keyword_label
from documents""")
def document_keyword_label(i: Inputs) -> DataFrame:
    from traitlens.functions.labels import family_friendliness
    d = i.table("documents")
    return d.select("doc_id", family_friendliness(F.col("text")).alias("keyword_label"))


# Context, excerpt, recommender -------------------------------------------------
CONTEXT_FILTERS = Filters(groups=("Working", "Sporting", "Terrier", "Hound"),
                          suitability=("Excellent for Families", "Good for Families"))


def _context_sql(f: Filters, limit: int | None) -> str:
    lim = f"order by b.breed_name, b.breed_id limit {limit}" if limit else ""
    temp = (f"where family_suitability in ({_in(f.suitability)})" if f.suitability else "")
    return f"""
base as (select breed_id, breed_name, breed_group, size_category, avg_weight_kg, avg_life_span_years
         from prof where {_filters_sql(f)}),
tmp as (select breed_id, family_suitability, array_to_string(trait_array, ', ') as temperament_traits
        from traits {temp}),
ctx as (select b.breed_id, b.breed_name, coalesce(b.breed_group, '') as breed_group,
               coalesce(b.size_category, '') as size_category, b.avg_weight_kg, b.avg_life_span_years,
               coalesce(tmp.family_suitability, '') as family_suitability,
               coalesce(tmp.temperament_traits, '') as temperament_traits
        from base b left join tmp on tmp.breed_id = b.breed_id {lim})"""


def _context_input(i: Inputs) -> DataFrame:
    return i.frame("breed_id", "breed_name", "breed_group", "size_category", "avg_weight_kg", "avg_life_span_years",
                   "family_suitability", "trait_array")


@register("context_table", _with(
    "select breed_name, breed_group, size_category, avg_weight_kg, avg_life_span_years, family_suitability,"
    " temperament_traits from ctx", _PROFILES + _BOUNDS + "," + _context_sql(CONTEXT_FILTERS, K.CONTEXT_MAX_ROWS)))
def context_table(i: Inputs) -> DataFrame:
    from traitlens.plans.context import context_table as build
    return build(_context_input(i), CONTEXT_FILTERS, limit=K.CONTEXT_MAX_ROWS)


@register("context_frame", _with("select * from ctx", _PROFILES + _BOUNDS + "," + _context_sql(CONTEXT_FILTERS, None)))
def context_frame_all(i: Inputs) -> DataFrame:
    from traitlens.plans.context import context_frame
    return context_frame(_context_input(i), CONTEXT_FILTERS)


def _num_sql(c: str) -> str:
    return f"coalesce(cast({c} as varchar), 'nan')"


_LINE_SQL = ("'- breed: ' || breed_name || '; group: ' || breed_group || '; size: ' || size_category"
             f" || '; avg_weight_kg: ' || {_num_sql('avg_weight_kg')}"
             f" || '; avg_lifespan_years: ' || {_num_sql('avg_life_span_years')}"
             " || '; family_suitability: ' || family_suitability || '; temperament_traits: ' || temperament_traits")


@register("grounding_excerpt", _with(f"""
select breed_group, n_rows,
  concat_ws(chr(10), {_in(K.EXCERPT_HEAD)}, string_agg(line, chr(10) order by rk),
            case when n_rows > {K.EXCERPT_MAX_ROWS} then '… and ' || cast(n_rows - {K.EXCERPT_MAX_ROWS} as varchar)
                 || ' more rows not shown' end) as excerpt
from (select breed_group, {_LINE_SQL} as line,
             row_number() over (partition by breed_group order by breed_name, breed_id) as rk,
             count(*) over (partition by breed_group) as n_rows from ctx)
where rk <= {K.EXCERPT_MAX_ROWS} group by breed_group, n_rows""",
    _PROFILES + _BOUNDS + "," + _context_sql(CONTEXT_FILTERS, None)))
def grounding_excerpt(i: Inputs) -> DataFrame:
    from traitlens.plans.context import context_frame, grounding_excerpt as build
    return build(context_frame(_context_input(i), CONTEXT_FILTERS), max_rows=K.EXCERPT_MAX_ROWS)


def _requests(i: Inputs) -> DataFrame:
    texts = F.array(*[F.lit(t) for t in K.REQUEST_TEXTS])
    return i.table("customer").select(
        "c_custkey", F.element_at(texts, (F.col("c_custkey") % len(K.REQUEST_TEXTS) + 1).cast("int"))
        .alias("request_text"))


def _requests_sql() -> str:
    arr = "[" + _in(K.REQUEST_TEXTS) + "]"
    return f"req as (select c_custkey, {arr}[c_custkey % {len(K.REQUEST_TEXTS)} + 1] as request_text from customer)"


def _intent_sql(t: str) -> str:
    def any_(words):
        return "(" + " or ".join(f"contains({t}, '{w}')" for w in words) + ")"
    size = " ".join(f"when {any_(words)} then '{label}'" for words, label in K.SIZE_WORDS)
    return (f"case {size} end as size_pref, contains({t}, '{K.APARTMENT_WORD}') as apartment, "
            f"{any_(K.FAMILY_WORDS)} as family, {any_(K.ACTIVE_WORDS)} as active, "
            f"{any_(K.CALM_WORDS)} as calm, {any_(K.GUARD_WORDS)} as guard")


def _score_sql() -> str:
    p = K.POINTS
    def any_(col, words):
        return "(" + " or ".join(f"contains({col}, '{w}')" for w in words) + ")"
    fam = " ".join(f"when lower(c.family_suitability) = '{k}' then {v}" for k, v in K.FAMILY_POINTS_LITERAL.items())
    tr = "lower(c.temperament_traits)"
    return f"""(case when i.size_pref is not null and contains(lower(c.size_category), i.size_pref) then {p['size']} else 0 end
 + case when i.apartment and lower(c.size_category) in ({_in(K.APARTMENT_SIZES)}) then {p['apartment_size']} else 0 end
 + case when i.apartment and c.avg_weight_kg <= {K.APARTMENT_MAX_KG} then {p['apartment_weight']} else 0 end
 + case when i.family then (case {fam} else 0 end) else 0 end
 + case when i.active and {any_(tr, K.ACTIVE_TRAITS)} then {p['active']} else 0 end
 + case when i.calm and {any_(tr, K.CALM_TRAITS)} then {p['calm']} else 0 end
 + case when i.guard and {any_(tr, K.GUARD_TRAITS)} then {p['guard']} else 0 end
 + case when c.avg_life_span_years >= {K.LIFESPAN_BONUS_YEARS} then {p['lifespan']} else 0 end)"""


_REC_CTES = f""",
{_requests_sql()},
reqi as (select c_custkey, request_text, {_intent_sql('lower(request_text)')} from req),
intents as (select distinct size_pref, apartment, family, active, calm, guard from reqi),
scored as (select i.*, c.*, cast({_score_sql()} as bigint) as score from intents i, ctx c),
ranked as (select *, row_number() over (partition by size_pref, apartment, family, active, calm, guard
                                       order by score desc, breed_name, breed_id) as suggestion_rank,
                  max(score) over (partition by size_pref, apartment, family, active, calm, guard) as best
           from scored),
tops as (select * from ranked where suggestion_rank <= {K.SUGGESTIONS_PER_REQUEST} and (score > 0 or best <= 0))"""

REC_FILTERS = Filters()


@register("recommend", _with("""
select r.c_custkey, t.suggestion_rank, t.breed_id, t.breed_name, t.score
from reqi r join tops t on t.size_pref is not distinct from r.size_pref and t.apartment = r.apartment
  and t.family = r.family and t.active = r.active and t.calm = r.calm and t.guard = r.guard""",
    _PROFILES + _BOUNDS + "," + _context_sql(REC_FILTERS, None) + _REC_CTES))
def recommend(i: Inputs) -> DataFrame:
    from traitlens.operators.recommend import recommend as build
    from traitlens.plans.context import context_frame
    return build(_requests(i), "request_text", context_frame(_context_input(i), REC_FILTERS), "c_custkey")


@register("recommend_text", _with(f"""
select r.c_custkey, r.request_text, concat_ws(chr(10), '{K.REC_PREFIX.replace("'", "''")}', m.body,
                                              '{K.REC_SUFFIX.replace("'", "''")}') as suggestions
from reqi r join (
  select size_pref, apartment, family, active, calm, guard,
         string_agg('- ' || breed_name || ': size=' || size_category || ', weight≈' || {_num_sql('avg_weight_kg')}
                    || 'kg, lifespan≈' || {_num_sql('avg_life_span_years')} || 'y, family=' || family_suitability
                    || '; temperament: ' || temperament_traits, chr(10) order by suggestion_rank) as body
  from tops group by all) m
  on m.size_pref is not distinct from r.size_pref and m.apartment = r.apartment and m.family = r.family
  and m.active = r.active and m.calm = r.calm and m.guard = r.guard""",
    _PROFILES + _BOUNDS + "," + _context_sql(REC_FILTERS, None) + _REC_CTES))
def recommend_text(i: Inputs) -> DataFrame:
    from traitlens.operators.recommend import recommend_text as build
    from traitlens.plans.context import context_frame
    return build(_requests(i), "request_text", context_frame(_context_input(i), REC_FILTERS), "c_custkey")


def _turns(i: Inputs) -> DataFrame:
    """Requests that users typed: their turns of the given conversations."""
    return i.table("conversations").where("role = 'user'").select(
        F.concat_ws("-", "conv_id", "turn").alias("request_id"), F.col("text").alias("request_text"))


_TURN_CTES = _REC_CTES.replace(_requests_sql(), """req as (
  select concat_ws('-', conv_id, turn) as request_id, text as request_text from conversations where role = 'user')""") \
    .replace("c_custkey", "request_id")
_BY_INTENT = """r.size_pref and t.apartment = r.apartment and t.family = r.family and t.active = r.active
  and t.calm = r.calm and t.guard = r.guard"""


@register("recommend_conversations", _with(f"""
select r.request_id, t.suggestion_rank, t.breed_id, t.breed_name, t.score
from reqi r join tops t on t.size_pref is not distinct from {_BY_INTENT}""",
    _PROFILES + _BOUNDS + "," + _context_sql(REC_FILTERS, None) + _TURN_CTES))
def recommend_conversations(i: Inputs) -> DataFrame:
    from traitlens.operators.recommend import recommend as build
    from traitlens.plans.context import context_frame
    return build(_turns(i), "request_text", context_frame(_context_input(i), REC_FILTERS), "request_id")


#: Points for the suitability labels that the model does emit.
FAMILY_POINTS = {"excellent for families": 3, "good for families": 2}


def _family_points_sql() -> str:
    literal = " ".join(f"when lower(c.family_suitability) = '{k}' then {v}" for k, v in K.FAMILY_POINTS_LITERAL.items())
    mine = " ".join(f"when lower(c.family_suitability) = '{k}' then {v}" for k, v in FAMILY_POINTS.items())
    return _REC_CTES.replace(literal, mine)


@register("recommend_family_points", _with(f"""
select r.c_custkey, t.suggestion_rank, t.breed_id, t.breed_name, t.score
from reqi r join tops t on t.size_pref is not distinct from {_BY_INTENT}""",
    _PROFILES + _BOUNDS + "," + _context_sql(REC_FILTERS, None) + _family_points_sql()))
def recommend_family_points(i: Inputs) -> DataFrame:
    from traitlens.operators.recommend import recommend as build
    from traitlens.plans.context import context_frame
    return build(_requests(i), "request_text", context_frame(_context_input(i), REC_FILTERS), "c_custkey",
                 family_points=FAMILY_POINTS)


NO_PROFILE = Filters(groups=("No such group",))


@register("recommend_text_empty", f"""
select concat_ws('-', conv_id, turn) as request_id, text as request_text, '{K.REC_EMPTY}' as suggestions
from conversations where role = 'user'""")
def recommend_text_empty(i: Inputs) -> DataFrame:
    """Requests under a filter that leaves no profile: each gets the fixed answer."""
    from traitlens.operators.recommend import recommend_text as build
    from traitlens.plans.context import context_frame
    return build(_turns(i), "request_text", context_frame(_context_input(i), NO_PROFILE), "request_id")


# Flatten, explode form -----------------------------------------------------------
@register("flatten_raw", _with("select * from raw"))
def flatten_raw(i: Inputs) -> DataFrame:
    from traitlens.sources.raw import flatten, nest
    return flatten(nest(i.raw))


@register("dim_traits_explode", _with("select * from traits"))
def dim_traits_explode(i: Inputs) -> DataFrame:
    from traitlens.operators.traits import trait_dimension_exploded
    return trait_dimension_exploded(i.stg)


# Stored star, archive, bronze ---------------------------------------------------------
def _folder(i: Inputs, name: str) -> str:
    """A new folder of the shared one that the cluster names."""
    return f"{checkpoint_dir(i.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _stored_star(i: Inputs) -> dict[str, str]:
    """The star and its tests written as bucketed tables of a schema of their own: name -> table."""
    from traitlens.sources.sinks import build_and_write_star

    schema = f"star_{uuid.uuid4().hex}"
    return build_and_write_star(i.spark, i.raw, schema, int(i.spark.conf.get("spark.sql.shuffle.partitions")),
                                now=AS_OF, location=_folder(i, "marts"))


@register("latest_snapshot_stored", ORACLE["latest_snapshot_profiles"])
def latest_snapshot_stored(i: Inputs) -> DataFrame:
    """The latest load over stored marts: three tables joined bucket by bucket (JN-1, JN-2, SRC-2, SNK-4, SNK-6)."""
    from traitlens.operators.joins import latest_only

    names = _stored_star(i)
    dim, fct, traits = (i.spark.table(names[t]) for t in ("dim_profiles", "fct_metrics", "dim_traits"))
    rows = latest_only(dim.select("breed_id", "breed_name", "size_category", "extraction_date"), "extraction_date") \
        .join(fct.where("has_weight_data").select("breed_id", "avg_weight_lbs"), "breed_id") \
        .join(traits.where("family_suitability = 'Excellent for Families'").select("breed_id", "family_suitability"),
              "breed_id")
    return rows.select("breed_name", "size_category", "avg_weight_lbs", "family_suitability")


@register("stored_rule_summary", ORACLE["dq_summary"])
def stored_rule_summary(i: Inputs) -> DataFrame:
    """The stored summary of the model rules, counted while the models were written (SNK-7, DQ-9)."""
    return i.spark.table(_stored_star(i)["rule_summary"]).where("kind not in ('recency', 'consistency')")


def _stored_failures_sql() -> str:
    parts = []
    for r in QR.star_rules():
        t = _SQL_TABLE[r.table]
        if r.kind in Q.ROW_KINDS:
            value = "cast(null as varchar)" if r.kind == "expression_is_true" else f"cast({r.column} as varchar)"
            parts.append(f"select '{r.name}' as test_name, cast(breed_id as bigint) as row_key, {value} as value, "
                         f"cast(1 as bigint) as n_rows from {t} where {_violation_sql(r)}")
        elif r.kind == "unique":
            parts.append("select test_name, cast(null as bigint) as row_key, value, n_rows from "
                         f"({_unique_sql(r, t)})")
        else:
            parts.append("select test_name, child_key as row_key, cast(null as varchar) as value, n_rows from "
                         f"({_orphans_sql(r, t, _SQL_TABLE[r.parent])})")
    return _with("\nunion all\n".join(parts))


@register("stored_failures", _stored_failures_sql())
def stored_failures(i: Inputs) -> DataFrame:
    """All stored failures of the model rules, from the tables that the build wrote (SNK-5, DQ-10)."""
    none, out = F.lit(None), None
    shape = {"failures": ("row_key", "value", F.lit(1)), "duplicates": (none, "value", "n_rows"),
             "orphans": ("child_key", none, "n_rows")}
    for name, table_name in _stored_star(i).items():
        kind = name.split("_")[0]
        if kind not in shape or name in ("failures_recency", "failures_consistency"):
            continue
        key, value, n = (F.col(c) if isinstance(c, str) else c for c in shape[kind])
        part = i.spark.table(table_name).select("test_name", key.cast("long").alias("row_key"),
                                                value.cast("string").alias("value"), n.cast("long").alias("n_rows"))
        out = part if out is None else out.unionByName(part)
    return out if out is not None else i.spark.createDataFrame(
        [], "test_name string, row_key long, value string, n_rows long")


@register("archive_replay", _with("""
select cast(extraction_date as date) as extraction_date, _dlt_load_id, count(*) as n_rows,
       count(distinct id) as n_profiles, min(extracted_at) as first_stamp
from raw where extraction_date = '2025-08-26' group by all"""))
def archive_replay(i: Inputs) -> DataFrame:
    """One date of the archive after that date's load has been written twice (SNK-2, SRC-1 as JSON, SRC-3).

    The replay replaces its own partitions only, and reading the date lists no other.
    """
    from traitlens.sources.raw import BRONZE_SCHEMA
    from traitlens.sources.sinks import archive_raw

    path = _folder(i, "archive")
    archive_raw(i.raw, path)
    archive_raw(i.raw.where("extraction_date = '2025-08-26'"), path)
    archive = i.spark.read.schema(BRONZE_SCHEMA).json(path)
    return archive.where("extraction_date = '2025-08-26'").groupBy(
        F.col("extraction_date").cast("date").alias("extraction_date"), "_dlt_load_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_profiles"),
        F.min("extracted_at").alias("first_stamp"))


@register("bronze_replace", _with("select * from raw"))
def bronze_replace(i: Inputs) -> DataFrame:
    """The bronze table after two loads: readers see the newest committed version, whole (SNK-1, SRC-1)."""
    from traitlens.sources.raw import read_bronze
    from traitlens.sources.sinks import replace_bronze

    path = _folder(i, "bronze")
    replace_bronze(i.raw.where("extraction_date = '2025-08-25'"), path, version=1)
    replace_bronze(i.raw, path, version=2)
    return read_bronze(i.spark, path)


@register("extract_ingest", _with("""
select id, name, weight__imperial, height__metric, life_span, temperament, 'load-1' as _dlt_load_id,
       'load-1-' || id as _dlt_id, cast('2025-08-27' as varchar) as extraction_date,
       timestamp '2025-08-27 06:00:00' as extracted_at
from raw"""))
def extract_ingest(i: Inputs) -> DataFrame:
    """Bronze after two extracts of several files each, streamed by their manifests; a third is not committed (SRC-3, SNK-1)."""
    import datetime as dt

    from traitlens.sources.raw import LOAD_COLUMNS, nest, read_bronze
    from traitlens.streaming.ingest import commit_extract, run_manifest_ingest

    folder = _folder(i, "extracts")
    landed = nest(i.raw.drop(*LOAD_COLUMNS))
    manifests = f"{folder}/manifests"
    days = iter((26, 27))
    for extract, rows in (("first", landed.where("id % 2 = 0")), ("second", landed), ("torn", landed.where("id % 3 = 0"))):
        for part in (rows.where("id % 5 < 2"), rows.where("id % 5 >= 2")):  # lands in two goes
            part.write.mode("append").json(f"{folder}/landing/{extract}")
        if extract == "torn":
            continue
        commit_extract(i.spark, f"{folder}/landing", extract, manifests)
        run_manifest_ingest(i.spark, f"{folder}/landing", manifests, f"{folder}/archive", f"{folder}/bronze",
                            checkpoint=f"{folder}/progress", keep=2,
                            clock=lambda: dt.datetime(2025, 8, next(days), 6, tzinfo=dt.timezone.utc))
    return read_bronze(i.spark, f"{folder}/bronze").select(
        "id", "name", "weight__imperial", "height__metric", "life_span", "temperament", "_dlt_load_id", "_dlt_id",
        "extraction_date", "extracted_at")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
