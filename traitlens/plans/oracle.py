"""DuckDB SQL that states each registered query independently of Spark.

The oracle is plain SQL over the driver's views. It shares only the raw
fixture text and the fixed values (lexicons, labels) with the Spark side.
The trait dimension is computed here in the explode form (unnest, left
join, group by), so it also checks the Spark array form against it.
"""

from __future__ import annotations

from traitlens import constants as K
from traitlens.sources.fixture import raw_profiles_sql


def _q(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _blank(x: str) -> str:
    return f"({x} is null or trim({x}) = '')"


def _present(x: str, sentinel: bool = True) -> str:
    s = f" and {x} <> 'NaN'" if sentinel else ""
    return f"coalesce(({x} is not null and trim({x}) <> ''{s}), false)"


def _nan_null(e: str, nan: str) -> str:
    return f"(case when isnan({e}) then null else {e} end)" if nan == "null" else e


def _range(x: str, idx: int, open_low: bool, nan: str) -> str:
    up = ""
    if open_low:
        pat = r"^up [-–] (\d+)$"
        val = "0.0" if idx == 1 else f"try_cast(regexp_extract({x}, '{pat}', 1) as double)"
        up = f" when regexp_matches({x}, '{pat}') then {val}"
    e = (f"(case when {_blank(x)} or {x} = 'NaN' then null{up}"
         f" when {x} like '%-%' or {x} like '%–%' then"
         f" try_cast(trim(string_split(replace({x}, '–', '-'), ' - ')[{idx}]) as double)"
         f" else try_cast(trim({x}) as double) end)")
    return _nan_null(e, nan)


def _years(x: str, high: bool) -> str:
    pat = r"(\d+) years?" if high else r"^(\d+)"
    return (f"(case when {_blank(x)} then null"
            f" when {x} like '%-%' or {x} like '%–%' then"
            f" try_cast(nullif(regexp_extract(replace({x}, '–', '-'), '{pat}', 1), '') as bigint)"
            rf" when regexp_matches({x}, '^\d+') then try_cast(nullif(regexp_extract({x}, '^(\d+)', 1), '') as bigint)"
            f" else null end)")


def _band(v: str, rules, rest: str | None = None, default: str | None = None) -> str:
    parts = [f"when {v} {op} {bound} then '{label}'" for op, bound, label in rules]
    if rest is not None:
        parts.append(f"when {v} is not null then '{rest}'")
    tail = f" else '{default}'" if default is not None else ""
    return f"(case {' '.join(parts)}{tail} end)"


def staging_ctes(nan: str = "null", part: str = "part") -> str:
    """CTEs ``raw``, ``stg0`` and ``stg`` (staging profiles)."""
    w, wm, h, hm, life = "weight__imperial", "weight__metric", "height__imperial", "height__metric", "life_span"
    size_bands = " ".join(f"when weight_max_lbs {op} {b} then '{lab}'" for op, b, lab in K.SIZE_BANDS)
    return f"""
raw as ({raw_profiles_sql(part)}),
stg0 as (
  select *,
    {_range(w, 1, True, nan)} as weight_min_lbs, {_range(w, 2, True, nan)} as weight_max_lbs,
    {_range(wm, 1, False, nan)} as weight_min_kg, {_range(wm, 2, False, nan)} as weight_max_kg,
    {_range(h, 1, False, nan)} as height_min_inches, {_range(h, 2, False, nan)} as height_max_inches,
    {_range(hm, 1, False, nan)} as height_min_cm, {_range(hm, 2, False, nan)} as height_max_cm,
    {_years(life, False)} as life_span_min_years, {_years(life, True)} as life_span_max_years
  from raw
),
stg as (
  select cast(id as bigint) as breed_id, trim(name) as breed_name, _dlt_load_id, _dlt_id,
    try_cast(extracted_at as timestamp) as extracted_at,
    try_cast(extraction_date as date) as extraction_date,
    trim(bred_for) as bred_for, trim(breed_group) as breed_group, trim(origin) as origin,
    trim(country_code) as country_code,
    weight_min_lbs, weight_max_lbs, weight_min_kg, weight_max_kg,
    height_min_inches, height_max_inches, height_min_cm, height_max_cm,
    life_span_min_years, life_span_max_years,
    nullif(trim(temperament), '') as temperament_raw,
    trim(description) as description, trim(history) as history,
    trim(reference_image_id) as reference_image_id,
    case when not {_present(w)} then null
         when regexp_matches({w}, '^up [-–] \\d+$') then '{K.SIZE_OPEN_LOW}'
         {size_bands}
         when weight_max_lbs is not null then '{K.SIZE_TOP}' end as size_category,
    {_present(w)} as has_weight_data,
    {_present(h, False)} as has_height_data,
    {_present(life, False)} as has_lifespan_data,
    {_present('temperament', False)} as has_temperament_data,
    ({_present(w)} and weight_min_lbs is null and weight_max_lbs is null)
      or ({_present(wm)} and weight_min_kg is null and weight_max_kg is null)
      or ({_present(h, False)} and height_min_inches is null and height_max_inches is null)
      or ({_present(hm, False)} and height_min_cm is null and height_max_cm is null)
      or ({_present(life, False)} and life_span_min_years is null and life_span_max_years is null)
      as parse_error
  from stg0
  where id is not null and trim(name) is not null
)"""


def _mid(lo: str, hi: str, places: int | None) -> str:
    mean = f"(({lo} + {hi}) / 2.0::double)"
    if places is not None:
        mean = f"round({mean}, {places})"
    return f"cast(coalesce({mean}, {hi}, {lo}) as double)"


_MEASURES = (
    ("avg_weight_lbs", "weight_min_lbs", "weight_max_lbs"),
    ("avg_weight_kg", "weight_min_kg", "weight_max_kg"),
    ("avg_height_inches", "height_min_inches", "height_max_inches"),
    ("avg_height_cm", "height_min_cm", "height_max_cm"),
    ("avg_life_span_years", "life_span_min_years", "life_span_max_years"),
)


def dim_cte() -> str:
    avgs = ",\n    ".join(f"{_mid(lo, hi, 1)} as {name}" for name, lo, hi in _MEASURES)
    activity = " ".join(f"when breed_group in ({_q(groups)}) then '{label}'"
                        for groups, label in K.ACTIVITY_BY_GROUP)
    return f"""
dim0 as (
  select *, {avgs}
  from stg
),
dim as (
  select breed_id, breed_name, breed_group, bred_for, origin, country_code, size_category,
    avg_weight_lbs, avg_weight_kg, avg_height_inches, avg_height_cm, avg_life_span_years,
    temperament_raw,
    cast(case when temperament_raw is not null then len(string_split(temperament_raw, ', ')) else 0 end as bigint)
      as temperament_trait_count,
    {_band('avg_life_span_years', K.LONGEVITY_BANDS, default=K.LONGEVITY_DEFAULT)} as longevity_category,
    case {activity} else '{K.ACTIVITY_DEFAULT}' end as inferred_activity_level,
    case when temperament_raw is not null and regexp_matches(lower(temperament_raw), '{K.FAMILY_PATTERN}')
           then 'Family-Friendly'
         when temperament_raw is not null and regexp_matches(lower(temperament_raw), '{K.GUARD_PATTERN}')
           and not regexp_matches(lower(temperament_raw), '{K.GUARD_EXCLUDE_PATTERN}')
           then 'Protective/Guardian'
         when temperament_raw is not null then 'Moderate'
         else 'Unknown' end as family_friendliness,
    description, history, reference_image_id,
    has_weight_data, has_height_data, has_lifespan_data, has_temperament_data,
    cast(has_weight_data as bigint) + cast(has_height_data as bigint)
      + cast(has_lifespan_data as bigint) + cast(has_temperament_data as bigint) as data_completeness_score,
    extracted_at, extraction_date
  from dim0
)"""


def fct_cte() -> str:
    avgs = ",\n    ".join(f"{_mid(lo, hi, None)} as {name}" for name, lo, hi in _MEASURES)
    ratio = "avg_weight_lbs / nullif(pow(avg_height_inches, 1.5), 0)"
    n_flags = ("(cast(has_weight_data as bigint) + cast(has_height_data as bigint)"
               " + cast(has_lifespan_data as bigint))")
    compl = " ".join(f"when {n_flags} = {n} then {frac}" for n, frac in K.METRIC_COMPLETENESS)
    return f"""
fct0 as (
  select *,
    weight_max_lbs - weight_min_lbs as weight_range_lbs,
    weight_max_kg - weight_min_kg as weight_range_kg,
    height_max_inches - height_min_inches as height_range_inches,
    height_max_cm - height_min_cm as height_range_cm,
    life_span_max_years - life_span_min_years as life_span_range_years,
    {avgs}
  from stg
),
fct as (
  select breed_id, breed_name,
    weight_min_lbs, weight_max_lbs, weight_range_lbs,
    weight_min_kg, weight_max_kg, weight_range_kg,
    height_min_inches, height_max_inches, height_range_inches,
    height_min_cm, height_max_cm, height_range_cm,
    life_span_min_years, life_span_max_years, life_span_range_years,
    avg_weight_lbs, avg_weight_kg, avg_height_inches, avg_height_cm, avg_life_span_years,
    case when avg_height_inches > 0 then round(avg_weight_lbs / pow(avg_height_inches, 1.5), 2) end
      as weight_height_ratio_imperial,
    case when avg_height_cm > 0 then round(avg_weight_kg / pow(avg_height_cm / 100.0, 1.5), 2) end
      as weight_height_ratio_metric,
    {_band(ratio, K.BUILD_BANDS, rest=K.BUILD_REST)} as build_type,
    {_band('weight_range_lbs', K.WEIGHT_CONSISTENCY_BANDS, rest=K.CONSISTENCY_REST)} as weight_consistency,
    {_band('height_range_inches', K.HEIGHT_CONSISTENCY_BANDS, rest=K.CONSISTENCY_REST)} as height_consistency,
    {_band('life_span_range_years', K.LIFESPAN_PREDICTABILITY_BANDS, rest=K.PREDICTABILITY_REST)}
      as lifespan_predictability,
    has_weight_data, has_height_data, has_lifespan_data,
    cast(case {compl} else {K.METRIC_COMPLETENESS_DEFAULT} end as double) as metrics_completeness_score,
    extracted_at, extraction_date
  from fct0
)"""


def traits_cte() -> str:
    """Trait dimension, explode form: unnest, left join back, group by."""
    counts = []
    for name, lex in K.LEXICONS.items():
        col = K.LEXICON_COLUMNS[name][0]
        counts.append(f"cast(coalesce(count_if(lower(t.trait) in ({_q(lex)})), 0) as bigint) as {col}")
    scores = []
    for name in K.LEXICONS:
        cnt, sc = K.LEXICON_COLUMNS[name]
        scores.append(f"cast(case when total_traits > 0 then {cnt} / total_traits else 0 end as double) as {sc}")
    count_cols = ", ".join(K.LEXICON_COLUMNS[n][0] for n in K.LEXICONS)
    order = [(K.LEXICON_COLUMNS[n][1], label) for n, label in K.PRIMARY_CATEGORIES]
    top = "greatest(" + ", ".join(s for s, _ in order) + ")"
    primary = " ".join(f"when {top} > 0 and {s} = {top} then '{label}'" for s, label in order)
    s, t = K.SUITABILITY_LABELS, K.TRAINING_LABELS
    return f"""
trait_items as (
  select breed_id, trim(u.trait) as trait
  from stg, unnest(string_split(temperament_raw, ', ')) as u(trait)
  where temperament_raw is not null and trim(u.trait) <> ''
),
trait_agg as (
  select s.breed_id, s.breed_name, s.temperament_raw,
    count(t.trait) as total_traits,
    case when count(t.trait) > 0 then list(t.trait order by t.trait) else []::varchar[] end as trait_array,
    {', '.join(counts)}
  from stg s left join trait_items t on s.breed_id = t.breed_id
  group by s.breed_id, s.breed_name, s.temperament_raw
),
trait_scores as (
  select breed_id, breed_name, temperament_raw, total_traits, trait_array,
    {', '.join(scores)},
    {count_cols}
  from trait_agg
),
traits as (
  select *,
    case {primary} else '{K.UNCLASSIFIED}' end as primary_temperament_category,
    {_band('total_traits', K.COMPLEXITY_BANDS, default=K.COMPLEXITY_DEFAULT)} as temperament_complexity,
    case when family_friendliness_score >= 0.4 and calm_score >= 0.2 then '{s[0]}'
         when family_friendliness_score >= 0.3 or calm_score >= 0.3 then '{s[1]}'
         when family_friendliness_score >= 0.2 then '{s[2]}'
         when protective_score >= 0.4 and independent_score <= 0.3 then '{s[3]}'
         else '{s[4]}' end as family_suitability,
    case when intelligence_score >= 0.3 and independent_score <= 0.2 then '{t[0]}'
         when intelligence_score >= 0.2 and independent_score <= 0.3 then '{t[1]}'
         when intelligence_score >= 0.1 or independent_score <= 0.4 then '{t[2]}'
         else '{t[3]}' end as training_difficulty
  from trait_scores
)"""


def star_ctes(nan: str = "null") -> str:
    """WITH-clause body defining raw, stg, dim, fct and traits."""
    return ",".join([staging_ctes(nan), dim_cte(), fct_cte(), traits_cte()])


def with_star(select: str, nan: str = "null") -> str:
    return f"with {star_ctes(nan)}\n{select}"
