"""Generated raw profiles at any scale, derived from the driver table ``part``.

One SQL text, runnable unchanged by Spark SQL and DuckDB over a relation
named by the ``{part}`` placeholder, so the Spark queries and the DuckDB
oracle read identical raw rows. It covers every range form, size band,
build band, trait category and the rule-breaking rows of FIXTURES F3.
The whole ``part`` table is used; ``%`` only chooses which text form a
row gets, it never drops rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from traitlens.sources.tables import table

RAW_PROFILES_SQL = """
select cast(p_partkey as bigint) as id,
       concat(' ', p_name, ' ', cast(p_partkey as varchar(20)), ' ') as name,
       p_brand as bred_for,
       case p_type when 'ECONOMY' then 'Toy' when 'LARGE' then 'Working'
                   when 'MEDIUM' then 'Hound' when 'PROMO' then 'Sporting'
                   when 'SMALL' then 'Terrier' else '' end as breed_group,
       case when p_partkey % 53 = 7 then '35-70' when p_partkey % 59 = 8 then '12f'
            when p_partkey % 61 = 9 then '5d - 9' else case p_partkey % 20
            when 0 then null when 1 then '' when 2 then 'NaN'
            when 3 then concat('up - ', cast(p_size as varchar(20)))
            when 4 then concat('up – ', cast(p_size as varchar(20)))
            when 5 then cast(p_size as varchar(20))
            when 6 then concat(cast(p_size as varchar(20)), ' – ', cast(p_size + p_partkey % 45 as varchar(20)))
            else concat(cast(p_size as varchar(20)), ' - ', cast(p_size + p_partkey % 75 as varchar(20)))
       end end as weight__imperial,
       case p_partkey % 20
            when 0 then null when 1 then '' when 2 then 'NaN'
            when 3 then concat('NaN - ', cast(p_size as varchar(20)))
            when 4 then concat('NaN – ', cast(p_size as varchar(20)))
            when 5 then cast(p_size as varchar(20))
            else concat(cast(p_size as varchar(20)), ' - ', cast(p_size + p_partkey % 30 as varchar(20)))
       end as weight__metric,
       case when p_partkey % 43 = 5 then '45 - 42.5' else case p_partkey % 11
            when 0 then null when 1 then '' when 2 then '11' when 3 then '0'
            else concat(cast(1 + p_partkey % 29 as varchar(20)), ' - ', cast(1 + p_partkey % 29 + p_partkey % 7 as varchar(20)), '.5')
       end end as height__imperial,
       case p_partkey % 11
            when 0 then null when 1 then '' when 2 then '28' when 3 then '0'
            else concat(cast(3 + p_partkey % 73 as varchar(20)), ' – ', cast(3 + p_partkey % 73 + p_partkey % 17 as varchar(20)))
       end as height__metric,
       case when p_partkey % 47 = 9 then '29 - 27 years' else case p_partkey % 13
            when 0 then null when 1 then '' when 2 then '12 years'
            when 3 then '10 - 12' when 4 then '8 – 15 years' when 5 then 'unknown'
            else concat(cast(7 + p_partkey % 6 as varchar(20)), ' - ', cast(7 + p_partkey % 6 + p_partkey % 8 as varchar(20)), ' years')
       end end as life_span,
       case when p_partkey % 17 = 0 then null when p_partkey % 19 = 0 then '  '
            when p_partkey % 37 = 0 then 'Friendly, Playful, Loyal, Alert, Calm, Proud, Reliable, Curious, Bold'
            when p_partkey % 29 = 0 then 'Aloof' when p_partkey % 31 = 0 then 'Calm, Quiet, Steady'
            else concat_ws(', ',
                 case when p_partkey % 2 = 0 then 'Friendly' end,
                 case when p_partkey % 3 = 0 then 'Gentle' end,
                 case when p_partkey % 4 = 1 then 'Active' end,
                 case when p_partkey % 5 = 0 then 'Intelligent' end,
                 case when p_size % 3 = 1 then 'Protective' end,
                 case when p_size % 4 = 2 then 'Stubborn' end,
                 case when p_size % 5 = 3 then 'Calm' end,
                 case when p_size % 2 = 1 then 'Eager' end,
                 case when p_partkey % 7 = 2 then 'Loyal' end,
                 case when p_partkey % 23 = 5 then '' end,
                 'Curious')
       end as temperament,
       case when p_partkey % 3 = 0 then 'Germany, France' end as origin,
       case when p_partkey % 3 = 0 then 'DE' end as country_code,
       cast(null as varchar(20)) as description,
       cast(null as varchar(20)) as history,
       concat('img', cast(p_partkey as varchar(20))) as reference_image_id,
       case when p_partkey % 4 = 0 then timestamp '2025-08-25 14:17:18'
            else timestamp '2025-08-26 14:17:18' end as extracted_at,
       case when p_partkey % 4 = 0 then '2025-08-25' else '2025-08-26' end as extraction_date,
       'load-1' as _dlt_load_id,
       concat('row-', cast(p_partkey as varchar(20))) as _dlt_id
from {part}
"""


def raw_profiles_sql(part_relation: str = "part") -> str:
    """The fixture SQL over a named relation (for DuckDB or a Spark view)."""
    return RAW_PROFILES_SQL.replace("{part}", part_relation)


def raw_profiles_from_part(spark: SparkSession, part: DataFrame) -> DataFrame:
    """Raw profiles over a ``part`` DataFrame (bound as a query parameter, no global view)."""
    return spark.sql(RAW_PROFILES_SQL, part=part.select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size"))


def raw_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw profiles from the whole ``part`` table of a driver data directory."""
    return raw_profiles_from_part(spark, table(spark, sf_dir, "part"))
