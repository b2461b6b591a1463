"""Tourism tables derived from the star-schema tables by SQL that Spark and DuckDB read alike.

{name} in a text is a table of the folder or another derived table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_X = "129.0 + ((p_partkey * p_partkey * 31 + p_partkey * 7919) % 503) / 10000.0"
_Y = "35.1 + ((p_partkey * p_partkey * 17 + p_partkey * 104729) % 509) / 10000.0"

DERIVED = {
    "menus": """select l_suppkey as food_place_id, p_name as menu_name, cast(floor(l_extendedprice) as int) as price,
        case when l_linestatus = 'O' then null else l_linenumber end as display_order, l_returnflag = 'R' as is_representative,
        l_orderkey, l_shipdate, 'good_price_menu' as menu_source
        from {lineitem} join {part} on l_partkey = p_partkey""",
    "matches": """select s_suppkey as food_place_id, cast(s_nationkey as string) as spot_content_id,
        case s_suppkey % 4 when 0 then 'matched' when 1 then 'pending' when 2 then 'separate' else 'rejected' end as match_status,
        case when s_suppkey % 5 = 0 then 'manual' else 'rule' end as match_method from {supplier}""",
    "spots": f"""select cast(p_partkey as string) as content_id,
        case p_partkey % 8 when 0 then '39' when 2 then '12' when 4 then '14' else '28' end as content_type_id,
        p_name || case when p_partkey % 6 = 0 then ' (' || p_brand || ')' else '' end as title,
        cast({_X} as double) as map_x, cast({_Y} as double) as map_y,
        cast(100 + p_partkey % 16 as string) as l_dong_signgu_cd, '26' as l_dong_regn_cd, true as source_tour_api, p_size > 2 as is_active,
        case when p_partkey % 3 = 0 then null else '051-' || cast(1000000 + p_partkey % 97 as string) end as tel,
        '부산광역시 ' || p_type as address, p_size, p_partkey
        from {{part}} where p_partkey % 2 = 0""",
    "food_places": f"""select p_partkey as id, p_name as name,
        case when p_partkey % 3 = 0 then null else '051-' || cast(1000000 + (p_partkey + 1) % 97 as string) end as tel,
        case when p_partkey % 7 = 0 then ' ' else '부산 ' || p_type end as address,
        case p_partkey % 5 when 0 then null when 1 then 'beauty' else 'food_korean' end as normalized_category,
        case when p_partkey % 11 = 0 then null else cast({_X} as double) end as map_x,
        case when p_partkey % 11 = 0 then null else cast({_Y} as double) end as map_y,
        p_size > 2 as is_active, cast(100 + p_partkey % 16 as string) as source_region, p_brand as representative_menu
        from {{part}} where p_partkey % 2 = 1""",
    "place_matches": """select o_custkey as food_place_id, cast(o_orderkey as string) as spot_content_id,
        case o_orderstatus when 'F' then 'matched' when 'O' then 'pending' else 'rejected' end as match_status,
        case when o_orderkey % 7 = 0 then 'manual' when o_orderkey % 11 = 0 then 'llm' else 'rule' end as match_method
        from {orders}""",
    "named_places": """select c_custkey as id, c_mktsegment || ' ' || cast(c_custkey % 300 as string) as name,
        case when cast(floor(c_custkey / 300) as int) % 2 = 0 then 'good_price_store' else 'good_price_menu' end as source,
        case when c_custkey % 3 = 0 then null when c_custkey % 3 = 1 then ' ' else 'addr ' || cast(c_custkey as string) end as address,
        case when c_custkey % 5 = 0 then '051' || cast(c_custkey as string) else null end as tel,
        case when c_custkey % 4 < 2 then null else cast(c_nationkey as string) end as source_region,
        case when c_custkey % 7 < 3 then null else 129.0 + c_custkey % 100 / 1000.0 end as map_x,
        case when c_custkey % 7 < 3 then null else 35.0 + c_custkey % 90 / 1000.0 end as map_y,
        c_custkey % 13 <> 0 as is_active, case when c_custkey % 17 = 0 then 'food_unknown' else 'food_korean' end as normalized_category
        from {customer}""",
    "forecast": """select case when user_id % 5 = 0 then null else cast(user_id as string) end as content_id, '26' as area_cd,
        event_type as signgu_cd, 'spot ' || cast(user_id as string) as raw_tats_name, cast(ts as date) as base_ymd,
        least(value / 5, 100) as rate, 'tourapi' as source, event_id as ordinal from {events}""",
    "run_log": """select o_orderkey as id, o_orderpriority as job_name,
        case o_orderstatus when 'F' then 'success' when 'O' then 'running' else 'failed' end as status,
        cast(floor(o_totalprice) as bigint) % 1000 as fetched, cast(floor(o_totalprice) as bigint) % 900 as upserted,
        cast(floor(o_totalprice) as bigint) % 37 as failed, cast(floor(o_totalprice) as bigint) % 211 as unmatched,
        o_orderkey % 5 <> 0 as complete, o_orderkey % 7 = 0 as stopped_by_budget, o_custkey as active_count, o_custkey % 300 as candidate_count
        from {orders}""",
    "course_items": """select cast(l_orderkey as string) as course_id, case when l_linenumber % 4 = 0 then null else cast(8 - l_linenumber as string) end as subnum,
        cast(l_partkey as string) as matched_spot_id, l_linenumber as pos from {lineitem}""",
    "courses": "select cast(o_orderkey as string) as content_id, o_orderstatus as theme, o_orderkey from {orders}",
    "observations": "select user_id as food_place_id, event_type as menu_name, cast(round(value) as int) as observed_price, ts as observed_at, event_id from {events}",
    "codes": """select substr(p_brand, 1, 6) as code1, substr(p_type, 1, 8) as code2, cast(p_size as string) as code3,
        case when p_partkey % 3 = 0 then 'pending_sync' else p_name end as name, p_partkey as ordinal from {part}""",
}


def _names(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A derived table, or one of the folder."""
    if name not in DERIVED:
        return spark.read.parquet(f"{folder}/{name}.parquet")
    return spark.sql(DERIVED[name], **{n: table(spark, folder, n) for n in _names(DERIVED[name])})


def oracle(body: str) -> str:
    """DuckDB SQL: body with the derived tables it names (as {name}) in front."""
    parts: dict[str, str] = {}

    def need(sql: str) -> str:
        for n in _names(sql):
            if n in DERIVED and n not in parts:
                text = need(DERIVED[n])
                parts[n] = text
        return re.sub(r"\{(\w+)\}", r"\1", sql)

    main = need(body)
    if not parts:
        return main
    with_ = ", ".join(f"{n} as ({t})" for n, t in parts.items())
    for start in ("with recursive ", "with "):
        if main.startswith(start):
            return f"{start}{with_}, {main[len(start):]}"
    return f"with {with_} {main}"
