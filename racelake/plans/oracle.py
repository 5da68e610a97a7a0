"""DuckDB SQL of the registered queries."""

LINES = r"""(select doc_id, i as line_no, parts[i] as line from (select doc_id, parts, unnest(range(1, len(parts) + 1)) as i from (
  select doc_id, case when parts[-1] = '' then parts[:-2] else parts end as parts from (
    select doc_id, regexp_split_to_array(text, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]') as parts from documents where text is not null))))"""
ACCENTED, BARE = "áàâäãéèêëíìîïóòôöõúùûüçñÁÀÂÄÃÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÇÑ", "aaaaaeeeeiiiiooooouuuucnAAAAAEEEEIIIIOOOOOUUUUCN"
PER_ORDER = "(select l_orderkey, count(*) as lines, max(l_linestatus) as line_status from lineitem group by 1)"
DAILY = """(select o_orderdate::date as day, count(*) as orders, coalesce(sum(lines), 0)::bigint as lines, count(*) filter (lines is null)::bigint as left_only,
  coalesce(sum(dups), 0)::bigint as duplicates, coalesce(sum(bad), 0)::bigint as size_violations, round(coalesce(sum(rev), 0), 4) as revenue
  from orders left join (select l_orderkey, sum(n) as lines, sum(n - 1) as dups, sum(bad) as bad, sum(rev) as rev from (
    select l_orderkey, l_linenumber, count(*) as n, count(*) filter (not l_quantity between 1 and 49) as bad, sum(l_extendedprice * (1 - l_discount)) as rev
    from lineitem group by 1, 2) group by 1) on o_orderkey = l_orderkey group by 1)"""
ORDER_SUMS = "(select l_orderkey, count(*) as lines, count(*) - count(distinct l_linenumber) as dups, count(*) filter (not l_quantity between 1 and 49) as bad from lineitem group by 1)"
GATED = f"""(select *, concat_ws(',', case when left_only <> 0 then 'left_only' end, case when duplicates <> 0 then 'duplicates' end, case when size_violations <> 0 then 'size_violations' end) as failures from {DAILY})"""
AS_OF = "(o_orderdate::date - 1 + interval '21 hours 30 minutes')::timestamp"
WITH_AS_OF = f"(select *, {AS_OF} as as_of from orders join lineitem on o_orderkey = l_orderkey)"
LINE_TEXT = "l_linenumber::varchar || ':' || l_partkey::varchar || ':' || l_quantity::bigint::varchar"
GROUP_DIGEST = f"(select l_orderkey, sha256(array_to_string(list_sort(list({LINE_TEXT})), ';')) as digest from lineitem group by 1)"
SHORT, LONG = "case when length(a) <= length(b) then a else b end", "case when length(a) <= length(b) then b else a end"


def _one(name: str, condition: str, source: str) -> str:
    return f"select '{name}' as rule, count(*) filter (not coalesce({condition}, false))::bigint as violations from {source}"


_CELLS = ["l_extendedprice", "l_linenumber", "l_orderkey", "l_quantity", "l_returnflag", "unit"]
_CELLS_DIFFER = " union all ".join(f"select unit, '{c}' as c from (select unit, l_orderkey, l_linenumber, {c} as v, 1 as s from a union all select unit, l_orderkey, l_linenumber, {c}, -1 from b) group by unit, l_orderkey, l_linenumber, v having sum(s) <> 0" for c in _CELLS)
READBACK = f"""
with a as (select strftime(l_shipdate, '%Y-%m') as unit, l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag from lineitem),
j as (select *, month((unit || '-01')::date) % 6 as k, row(l_orderkey, l_linenumber, l_extendedprice) as me, min(row(l_orderkey, l_linenumber, l_extendedprice)) over w as low, max(row(l_orderkey, l_linenumber, l_extendedprice)) over w as high,
  first_value(l_extendedprice) over (partition by unit order by l_orderkey, l_linenumber, l_extendedprice) as low_price, first_value(l_extendedprice) over (partition by unit order by l_orderkey desc, l_linenumber desc, l_extendedprice desc) as high_price from a window w as (partition by unit)),
b as (select unit, l_orderkey, l_linenumber, l_quantity + case when k = 1 and me = low then 1 else 0 end as l_quantity, case when k = 2 and me = low then high_price when k = 2 and me = high then low_price else l_extendedprice end as l_extendedprice, l_returnflag
  from (select *, unnest(case when k = 4 and me = high then [1, 2] else [1] end) from j where not (k = 3 and me = low))),
d as (select unit, string_agg(c, ',' order by c) as cells from (select distinct unit, c from ({_CELLS_DIFFER})) group by unit),
n as (select unit, count(*) as n from a group by 1), m as (select unit, count(*) as m from b group by 1)
select unit, n as rows, concat_ws(',', cells, case when n <> m then '<rows>' end) as differs, case when cells is null and n = m then 'SUCCESS' else 'FAILED' end as status from n join m using (unit) left join d using (unit)
"""

ORACLES = {
    "text_lines": f"select doc_id, line_no::int as line_no, line from {LINES}",
    "normalize_text": f"select doc_id, line_no::int as line_no, translate(line, '{ACCENTED}', '{BARE}') as norm from {LINES}",
    "clean_text": "select p_partkey, regexp_replace(p_name, '\\s+', '', 'g') as name, upper(trim(p_type)) as kind, case when length(p_partkey::varchar) >= 8 then p_partkey::varchar else lpad(p_partkey::varchar, 8, '0') end as key8 from part",
    "unmatched_rows": f"select doc_id, count(*) as n, min(line_no)::bigint as first_line from {LINES} where regexp_matches(line, '^[A-Z]') and not regexp_matches(line, '\\.$') group by 1",
    "classify_lines": f"select doc_id, case when regexp_matches(line, '^[ \\t]*$') then 'blank' when regexp_matches(line, '[0-9]{{3}}') then 'digits' when regexp_matches(line, '\\.$') then 'sentence' when contains(line, '***') or contains(line, '###') then 'rule' else 'other' end as kind, count(*) as n from {LINES} group by 1, 2",
    "explode_matches": "select page_id, i::int as pos, u[i] as url from (select page_id, u, unnest(range(1, len(u) + 1)) as i from (select page_id, regexp_extract_all(html, 'href=\"([^\"]*)\"', 1) as u from pages))",
    "files_without_rows": f"select doc_id from documents where doc_id not in (select doc_id from {LINES} where regexp_matches(line, '[0-9]{{3}}'))",
    "key_from_name": "select c_custkey, k as name_key, k = c_custkey as same from (select c_custkey, regexp_extract(c_name, '#([0-9]+)$', 1)::bigint as k from customer)",
    "code_map": "select case o_orderpriority when '1-URGENT' then 'U' when '2-HIGH' then 'H' when '3-MEDIUM' then 'M' when '4-NOT SPECIFIED' then 'N' when '5-LOW' then 'L' end as code, count(*) as n from orders group by 1",
    "tolerant_cast": "select sum(try_cast(regexp_extract(p_brand, '#(.*)$', 1) as int))::bigint as brand_sum, count(*) filter (try_cast(regexp_extract(p_brand, '#(.*)$', 1) as int) is null) as brand_nulls, count(*) filter (try_cast(p_type as int) is null) as type_nulls from part",
    "status_case": "select case o_orderstatus when 'F' then 'FINISHED' when 'O' then 'OPEN' when 'P' then 'PARTIAL' end as label, count(*) as n from orders group by 1",
    "context_ffill": "select conv_id, turn, last_value(case when role in ('user', 'system') then turn end ignore nulls) over (partition by conv_id order by turn rows between unbounded preceding and current row) as ctx_turn from conversations",
    "selection_no": "select event_id, row_number() over (partition by user_id, event_type, ts::date order by ts, event_id)::int as no from events",
    "exactly_one_per_group": "select o_custkey, case when n = 1 then file end as file, n from (select o_custkey, max(o_orderkey) as file, count(*) as n from (select *, max(o_orderstatus = 'O') over (partition by o_custkey) as best from orders) where (o_orderstatus = 'O') = best group by 1)",
    "daily_files": """with f as (select *, case when name[1] in ('B', 'b') then 'program' when name[1] in ('K', 'k') then 'result' end as kind, coalesce(said, case when regexp_matches(name, '^[BKk][0-9]{6}') then '20' || name[2:3] || '-' || name[4:5] || '-' || name[6:7] end) as day from
        (select case when o_orderkey % 50 = 7 then 'X' when o_orderkey % 10 = 3 then 'k' when o_orderkey % 2 = 0 then 'B' else 'K' end || case when o_orderkey % 97 = 5 then 'none' else strftime(o_orderdate, '%y%m%d') end || '_' || o_orderkey as name, case when o_orderkey % 100 = 57 then strftime(o_orderdate, '%Y-%m-%d') end as said from orders)),
      p as (select *, name[1] = 'k' as best, max(name[1] = 'k') over (partition by day, kind) as top from f where day is not null and kind is not null),
      c as (select day, max(name) filter (kind = 'program') as program, max(name) filter (kind = 'result') as result from (select day, kind, max(name) as name from p where best = top group by 1, 2 having count(*) = 1) group by 1),
      m as (select day, count(*) filter (day is null) as undated, count(*) filter (kind is null) as unknown, array_to_string(list(name order by name)[1:10], ',') as misfits from f where day is null or kind is null group by 1)
      select coalesce(c.day, m.day) as race_date, program, result, coalesce(undated, 0) as undated, coalesce(unknown, 0) as unknown, misfits from c full join m on c.day is not distinct from m.day""",
    "pair_completeness": "select case when d.doc_id is null then 'label_only' when l.doc_id is null then 'doc_only' else 'both' end as status, count(*) as n from documents d full join labels l on d.doc_id = l.doc_id group by 1",
    "incremental_skip": "select distinct o_orderdate::date::varchar as day from orders where o_orderdate::date not in (select l_shipdate::date from lineitem)",
    "readback_counts": "select count(*) as units, sum(n + (l_orderkey % 100 = 0)::int)::bigint as recorded_rows, sum(n)::bigint as actual_rows, count(*) filter (l_orderkey % 100 = 0) as mismatches from (select l_orderkey, count(*) as n from lineitem group by 1)",
    "readback_content": READBACK,
    "schema_contract": "with c as (select count(*) filter (l_orderkey is null)::bigint as n, count(*) filter (o_orderkey is null)::bigint as o from orders full join " + PER_ORDER + """ on o_orderkey = l_orderkey)
  select * from (values ('l_commitdate', 'missing', 0::bigint), ('o_orderstatus', 'extra', 0), ('l_orderkey', 'order', 0), ('lines', 'order', 0), ('o_orderkey', 'order', 0), ('o_orderkey', 'type', 0), ('o_orderkey', 'nullable', 0), ('lines', 'nullable', 0), ('line_status', 'nullable', 0), ('o_orderstatus', 'prohibited', 0)) t(column_name, problem, nulls)
  union all select 'lines', 'nulls', n from c where n > 0 union all select 'line_status', 'nulls', n from c where n > 0 union all select 'o_orderkey', 'nulls', o from c where o > 0""",
    "contract_projection": "select l_orderkey as race_key, l_linenumber as entry_no, l_suppkey as racer, l_quantity as weight, l_returnflag as flag, l_linestatus as state from lineitem",
    "json_required_fields": "select event_type, count(*) filter (k is null) as missing_k, sum(k)::bigint as sum_k from (select event_type, json_extract(props, '$.k')::bigint as k from events) group by 1",
    "json_forbidden_keys": """select event_type, path, key, count(*) as n from (select event_type, unnest(case event_id % 3 when 0 then [struct_pack(path := '$', key := 'k')] when 1 then [struct_pack(path := '$.a', key := 'Result'), struct_pack(path := '$.a.Result[1]', key := 'k')]
  else [struct_pack(path := '$[0][0].b', key := 'k'), struct_pack(path := '$[0][0].c', key := 'odds')] end, recursive := true) from events) group by 1, 2, 3""",
    "null_blank_split": "select c_nationkey, case when c_custkey % 3 = 0 then 'placeholder' when c_custkey % 5 = 0 then 'blank' else 'normal' end as kind, count(*) as n from customer group by 1, 2",
    "range_check": " union all ".join((_one("quantity", "l_quantity between 1 and 49", "lineitem"), _one("discount", "l_discount between 0 and 0.09", "lineitem"), _one("tax", "l_tax between 0 and 0.07", "lineitem"), _one("integral_quantity", "l_quantity = floor(l_quantity)", "lineitem"))),
    "text_rules": " union all ".join((_one("brand", "regexp_full_match(p_brand, 'Brand#[0-9]{2}')", "part"), _one("part_name", "trim(p_name) <> ''", "part"), _one("customer_name", "regexp_full_match(c_name, 'Customer#[0-9]{9}')", "customer"))),
    "enum_check": _one("event_type", "lower(trim(event_type)) in ('view', 'click', 'purchase')", "events"),
    "conditional_required": _one("purchase_value", "event_type <> 'purchase' or value > 5", "events") + " union all " + _one("error_value", "event_type <> 'error' or value <= 5", "events"),
    "date_homogeneity": "select l_orderkey, count(distinct strftime(l_shipdate, '%Y-%m')) as months from lineitem group by 1 having count(distinct strftime(l_shipdate, '%Y-%m')) > 1",
    "array_validity": "select label, count(*) as n, count(*) filter (len(embedding) <> 64) as bad_size, count(*) filter (len(list_distinct(embedding)) < len(embedding)) as repeated, count(*) filter (list_min(embedding) < -1 or list_max(embedding) > 1) as out_of_range from embeddings group by 1",
    "attach_provenance": "select n_name, count(*) as n from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1",
    "outer_reconcile": f"select strftime(o_orderdate, '%Y-%m') as month, count(*) filter (o_orderkey is not null and l_orderkey is not null) as both_sides, count(*) filter (l_orderkey is null) as left_only, count(*) filter (o_orderkey is null) as right_only, count(*) filter (o_orderkey is not null and l_orderkey is not null and coalesce(o_orderstatus <> line_status, true)) as status_mismatch from orders full join {PER_ORDER} on o_orderkey = l_orderkey group by 1",
    "group_absence": f"select o_orderkey, o_custkey, case when gone = 0 then 'none' when gone = n then 'all' else 'some' end as absence from (select o_orderkey, o_custkey, count(*) over w as n, count(*) filter (l_orderkey is null) over w as gone from orders left join {PER_ORDER} on o_orderkey = l_orderkey window w as (partition by o_custkey))",
    "conditional_anti": "select o_orderstatus, count(*) as n from orders where o_orderstatus <> 'P' or o_orderkey in (select l_orderkey from lineitem) group by 1",
    "key_set_diff": "with a as (select distinct c_custkey as k from customer), b as (select distinct o_custkey as k from orders) select (select count(*) from a where k not in (select k from b)) as left_only, (select count(*) from b where k not in (select k from a)) as right_only, (select count(*) from a where k not in (select k from b)) + (select count(*) from b where k not in (select k from a)) as symmetric",
    "name_match": f"select case when a = b then 'exact' when starts_with(a, b) or starts_with(b, a) then 'prefix' when regexp_matches({LONG}, array_to_string(list_transform(string_split({SHORT}, ''), lambda c: regexp_escape(c)), '.*')) then 'subsequence' else 'unexplained' end as kind, count(*) as n from (select lower(p_type) as a, lower(p_name) as b from part) group by 1",
    "grid_coverage": "with e as (select distinct ts::date as day, user_id, event_type from events), g as (select day, user_id, t as event_type from (select distinct day, user_id from e), (select unnest(['view', 'click', 'purchase', 'signup']) as t)), j as (select coalesce(g.day, e.day) as day, g.day is not null as wanted, e.day is not null as there from g full join e on g.day = e.day and g.user_id = e.user_id and g.event_type = e.event_type) select day::varchar as day, count(*) filter (wanted) as expected, count(*) filter (wanted and there) as present, count(*) filter (wanted and not there) as missing, count(*) filter (not wanted) as unexpected from j group by 1",
    "inventory": "with e as (select distinct ts::date::varchar as day, event_type from events), c as (select unnest(['view', 'click', 'purchase', 'refund', 'signup']) as t, unnest([1, 2, 3, 10, 11]) as pos), g as (select day, t, pos from (select distinct day from e), c), j as (select coalesce(g.day, e.day) as day, g.t, g.pos, e.event_type as e from g full join e on g.day = e.day and g.t = e.event_type) select day, count(*) filter (t is not null and e is not null) as present, coalesce(string_agg(t, ',' order by pos) filter (e is null), '') as missing, coalesce(string_agg(e, ',' order by e) filter (t is null), '') as unexpected from j group by 1",
    "grid_expand": "select o_orderkey, i::int as no, c[i] as code from (select o_orderkey, ['WIN', 'PLACE', 'EXACTA', 'QUINELLA', 'QUINELLA_PLACE', 'TRIFECTA', 'TRIO'] as c, unnest(range(1, 8)) as i from orders where o_orderstatus = 'F')",
    "category_completeness": "with e as (select strftime(ts, '%Y-%m') as month, ts::date as day, user_id, lower(trim(event_type)) as kind from events) select * from (select month, list_sort(list(distinct kind)) = ['click', 'error', 'purchase', 'signup', 'view'] as complete from e group by 1) join (select month, count(*) filter (k < 5) as incomplete_days from (select month, day, user_id, count(distinct kind) as k from e group by 1, 2, 3) group by 1) using (month)",
    "group_member_set": "select l_orderkey, count(*) as n from lineitem group by 1 having min(l_linenumber) = 1 and max(l_linenumber) = count(*) and count(distinct l_linenumber) = count(*)",
    "group_size": "select n, count(*) as orders from (select l_orderkey, count(*) as n from lineitem group by 1) where n <> 4 group by 1",
    "dup_surplus": "select l_returnflag, sum(n - 1)::bigint as surplus from (select l_returnflag, l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2, 3) group by 1",
    "dup_groups": "select coalesce(sum(n) filter (n > 1), 0)::bigint as dup_rows, count(*) filter (n > 1) as dup_groups from (select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2)",
    "value_counts": "select case when o_orderkey in (select l_orderkey from lineitem) then o_orderstatus else 'CANCELLED' end as value, count(*) as n from orders group by 1",
    "null_profile": f"with j as (select * from orders left join {PER_ORDER} on o_orderkey = l_orderkey) " + " union all ".join(f"select '{c}' as column_name, count(*) filter ({c} is null) as nulls, count(*) filter (trim({c}::varchar) = '') as blanks from j" for c in ("o_orderkey", "o_orderstatus", "o_orderpriority", "lines", "line_status")),
    "distinct_counts": "select count(distinct quality) as without_null, count(distinct coalesce(quality, -1)) as with_null from documents left join labels using (doc_id)",
    "group_homogeneity": "select homogeneous, count(*) as n from (select count(distinct coalesce(l_linestatus, '-')) = 1 as homogeneous from lineitem group by l_orderkey) group by 1",
    "daily_quality": f"select * replace (day::varchar as day) from {DAILY}",
    "quality_gate": f"select day::varchar as day, failures, case when failures = '' then 'SUCCESS' else 'FAILED' end as status from {GATED}",
    "monthly_rollup": f"select *, case when failed_days = 0 and days = day(last_day((month || '-01')::date)) then 'SUCCESS' when ok_days > 0 then 'PARTIAL' else 'FAILED' end as status from (select strftime(day, '%Y-%m') as month, count(*) as days, count(*) filter (failures = '') as ok_days, count(*) filter (failures <> '') as failed_days, sum(lines)::bigint as lines, sum(orders)::bigint as orders from {GATED} group by 1)",
    "period_audit": "with j as (select strftime(o_orderdate, '%Y-%m') as month, lineitem.* from orders join lineitem on o_orderkey = l_orderkey), s as (select coalesce(month, 'PERIOD') as scope, count(*) as rows, count(*) filter (l_quantity > 45)::bigint as large from j group by grouping sets ((month), ())), d as (select month as scope, sum(n - 1)::bigint as surplus from (select month, l_orderkey, l_linenumber, count(*) as n from j group by 1, 2, 3) group by 1 union all select 'PERIOD', sum(n - 1)::bigint from (select l_orderkey, l_linenumber, count(*) as n from j group by 1, 2)) select * from s join d using (scope)",
    "failed_checks_long": " union all ".join(
        f"select day::varchar as scope, '{m}' as check_name, 0::bigint as expected, {m} as actual, array_to_string(list_sort(x)[:10], ',') as details from {DAILY} join (select o_orderdate::date as d, list(o_orderkey::varchar) as x from orders left join {ORDER_SUMS} on o_orderkey = l_orderkey where {c} group by 1) on d = day where {m} <> 0"
        for m, c in (("left_only", "lines is null"), ("duplicates", "dups > 0"), ("size_violations", "bad > 0"))
    ),
    "semantic_audit": "select *, actual = 0 as passed from (" + " union all ".join(f"select '{n}' as check_name, count(*) filter ({c}) as actual from events" for n, c in (("null_keys", "user_id is null or event_type is null"), ("blank_types", "trim(event_type) = ''"), ("unknown_types", "event_type not in ('view', 'click', 'purchase', 'signup', 'error')"), ("negative_values", "not coalesce(value >= 0, false)"), ("error_values", "event_type = 'error' and value > 5"))) + " union all select 'duplicate_ids', (count(*) - count(distinct event_id)) from events)",
    "payout_meaning": """with o as (select strftime(o_orderdate, '%Y-%m-%d') as d, lpad((o_custkey % 24 + 1)::varchar, 2, '0') as v, o_orderkey as r from orders),
      j as (select *, case when l_linenumber = 1 then r % 50 end as k, ['WIN', 'PLACE', 'EXACTA', 'QUINELLA', 'QUINELLA_PLACE', 'TRIFECTA', 'TRIO'][l_linenumber] as t, ['1', '1', '1-2', '1-2', '1-2', '1-2-3', '1-2-3'][l_linenumber] as x from lineitem join o on l_orderkey = r),
      p as (select d, case k when 2 then null when 4 then ' ' else v end as v, r, case when k = 3 then null else t end as t, case when k = 1 then chr(9) when k in (5, 7, 8, 9, 10) then null else x end as c, case when k in (7, 8) then 100 when k = 9 then null when k = 10 then 70 else (l_quantity * 100)::bigint end as y,
        case when k = 5 then 'REFUND' when k in (6, 7) then 'CANCELLED' when k in (8, 10) then 'SPECIAL_PAYOUT' when k = 9 then 'NOT_ESTABLISHED' else 'NORMAL' end as s from j),
      q as (select *, c is not null and trim(c, chr(9)) = '' as blank, c is not null and trim(c, chr(9)) <> '' as normal, c is null as holder from p),
      rp as (select distinct d, v, r from o where r % 50 <> 11), ry as (select distinct d, v, r from p),
      n as (select 'program_columns' as check_name, 0::bigint as actual union all select 'payout_columns', 0 union all select 'blank_combination', count(*) from q where blank union all select 'null_race_keys', count(*) from q where v is null union all select 'null_bet_type', count(*) from q where t is null
        union all select 'null_normal_keys', coalesce(sum((v is null)::int + (t is null)::int), 0)::bigint from q where normal union all select 'blank_keys', count(*) from q where trim(v) = '' union all select 'placeholder_status', count(*) from q where holder and s not in ('CANCELLED', 'NOT_ESTABLISHED', 'SPECIAL_PAYOUT')
        union all select 'normal_status', count(*) from q where normal and s <> 'NORMAL' union all select 'placeholder_amount', count(*) from q where holder and s in ('CANCELLED', 'NOT_ESTABLISHED') and y is not null union all select 'special_amount', count(*) from q where holder and s = 'SPECIAL_PAYOUT' and y is distinct from 70
        union all select 'duplicate_normal', coalesce(sum(n), 0)::bigint from (select count(*) as n from q where normal group by d, v, r, t, c having count(*) > 1) union all select 'duplicate_placeholder', coalesce(sum(n), 0)::bigint from (select count(*) as n from q where holder group by d, v, r, t having count(*) > 1)
        union all select 'program_only_races', count(*) from (from rp except from ry) union all select 'payout_only_races', count(*) from (from ry except from rp))
      select check_name, actual, actual = 0 as passed from n""",
    "repeated_keys": """with k as (select 'line_duplicate_rows' as check_name, strftime(l_shipdate, '%Y-%m') as month, l_orderkey || '/' || l_linenumber as x from lineitem
        union all select 'event_duplicate_rows', strftime(ts, '%Y-%m'), user_id || '/' || case when event_id % 50 = 0 then '<NULL>' else event_type end || '/' || strftime(ts, '%d %H:%M') from events),
      g as (select check_name, month as scope, x, count(*) as n from k group by all having count(*) > 1 union all select check_name, 'PERIOD', x, count(*) from k group by check_name, x having count(*) > 1)
      select scope, check_name, sum(n)::bigint as actual, array_to_string(list(x order by x)[1:10], ',') as details from g group by all""",
    "top_examples": "select * from (select l_returnflag, l_orderkey, l_linenumber, n, row_number() over (partition by l_returnflag order by n desc, l_orderkey, l_linenumber)::int as rn from (select l_returnflag, l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2, 3) where n > 1) where rn <= 10",
    "lag_interval": "select user_id, count(gap) as gaps, count(*) filter (not gap between 5 and 90) as outside from (select user_id, (epoch_us(ts) - lag(epoch_us(ts)) over (partition by user_id order by ts, event_id)) / 60000000 as gap from events) group by 1",
    "order_check": "select day::varchar as day, count(*) filter (u < pu or (u = pu and e < pe)) as falls from (select ts::date as day, user_id as u, event_id as e, lag(user_id) over w as pu, lag(event_id) over w as pe from events window w as (order by ts, event_id)) group by 1",
    "event_chain": "select conv_id, bool_and(turn = rn - 1) as contiguous, bool_or(coalesce(role = before, false)) as repeats_role, bool_or(coalesce(turn > last_a, true)) as open_end, count(*) as turns from (select *, row_number() over w as rn, lag(role) over w as before, max(case when role = 'assistant' then turn end) over (partition by conv_id) as last_a from conversations window w as (partition by conv_id order by turn)) group by 1",
    "ordered_output": "select n_name, c_custkey, c_acctbal from customer join nation on c_nationkey = n_nationkey order by n_name, c_custkey",
    "union_by_name": "select 'customer' as kind, count(*) as n, count(*) filter (c_mktsegment is null) as null_segments from customer union all select 'supplier', count(*), count(*) from supplier",
    "as_of_time": f"select o_orderkey, {AS_OF} as as_of from orders",
    "pit_gate": f"select strftime(o_orderdate, '%Y-%m') as month, case when l_shipdate <= as_of then 'FETCHED_BY_AS_OF' when l_shipdate > as_of then 'FETCHED_AFTER_AS_OF' end as status, count(*) as n from {WITH_AS_OF} group by 1, 2",
    "pit_audit": f"select count(*) as rows, count(*) filter (l_shipdate is null or as_of is null) as nulls, count(*) filter (l_shipdate is not null and l_linenumber = 7) as invalid_timestamps, count(*) filter (l_shipdate > as_of) as future_rows, count(*) filter (greatest(l_shipdate, o_orderdate) <> l_shipdate) as alias_mismatch, count(*) filter (o_orderstatus not in ('O', 'F')) as ineligible, count(distinct l_suppkey) as sources, count(distinct o_orderpriority) as deadlines from {WITH_AS_OF}",
    "temporal_order": f"select o_orderstatus, count(*) as n, count(*) filter (not coalesce(o_orderdate <= l_shipdate, false)) as violations from {WITH_AS_OF} group by 1",
    "aware_timestamp": "select event_type, count(*) as n, count(*) filter (event_id % 2 = 0) as parsed, max(floor(epoch(ts))::bigint) filter (event_id % 2 = 0) as latest from events group by 1",
    "plan_report": "select case when timestamp '1996-06-30 12:00:00' <= day - 1 + interval '21 hours 30 minutes' then 'START' else 'BLOCKED' end as plan, count(*) as days from (select distinct o_orderdate::date as day from orders) group by 1",
    "allowlist_exclusion": "select case when s_suppkey is null then 'PRODUCTION' when s_suppkey % 5 <> 0 and l_returnflag in ('A', 'N', 'R') then 'RESEARCH_ONLY' else 'EXCEPTION_DIFFERS' end as use, count(*) as n from lineitem left join (select s_suppkey from supplier where s_acctbal < 0) on l_suppkey = s_suppkey group by 1",
    "nested_group_rules": """with f as (select case o_orderkey % 12 when 1 then 'races' when 2 then 'gaps' when 3 then 'kinds' when 4 then 'bad_times' when 5 then 'started_late' when 6 then 'after_deadline' when 7 then 'bad_status' when 8 then 'bad_digest' when 9 then 'fields' when 10 then 'fields' when 11 then 'gaps,bad_status' else '' end as failures from orders)
      select failures, case failures when '' then 'SUCCESS' else 'FAILED' end as status, count(*) as n from f group by 1, 2""",
    "field_agreement": """with a as (select l_orderkey as k, count(*) as n, max(l_shipdate) as l, case when min(l_linestatus) = max(l_linestatus) then min(l_linestatus) else 'P' end as s from lineitem group by 1),
      b as (select l_orderkey as k, count(*) as n, case l_orderkey % 20 when 2 then (max(l_shipdate)::date - 1)::timestamp when 3 then null else max(l_shipdate) end as l, any_value(o_orderstatus) as s from lineitem join orders on l_orderkey = o_orderkey where not (l_orderkey % 20 = 1 and l_linenumber = 1) group by 1)
      select count(*) filter (a.k is not null and b.k is not null) as units, count(*) filter (a.k is null or b.k is null) as one_sided, count(*) filter (a.k is not null and b.k is not null and a.n is distinct from b.n) as n_differs,
        count(*) filter (a.k is not null and b.k is not null and a.l is distinct from b.l) as last_differs, count(*) filter (a.k is not null and b.k is not null and a.s is distinct from b.s) as st_differs from a full join b on a.k = b.k""",
    "decision_rules": "with d as (select o_orderkey as k, o_orderstatus as s, o_orderkey % 50 = 1 as blank from orders) select unnest(['status_known', 'eligible_exactly_if_status', 'reason_given', 'race_date_given', 'as_of_time_given', 'record_status', 'record_eligible', 'record_reason', 'record_as_of_time']) as rule, unnest([count(*) filter (s not in ('F', 'O')), count(*) filter (k % 100 = 0), count(*) filter (blank), 0, 0, 0, 0, count(*) filter (k % 25 = 2), 0])::bigint as violations from d",
    "failure_taxonomy": "select case when event_id % 7 = 0 then 'SKIPPED_PROVENANCE_MISSING' when event_id % 10 = 0 or event_type = 'click' then 'SKIPPED_PROGRAM_UNAVAILABLE' when event_type = 'view' then 'SKIPPED_HASH_MISMATCH' when event_type = 'purchase' then 'SKIPPED_PROHIBITED_FEATURE' when event_type = 'signup' then 'SKIPPED_METADATA_INVALID' else 'SKIPPED_OUTPUT_INTEGRITY_ERROR' end as status, count(*) as n from events group by 1",
    "message_taxonomy": "select case when regexp_matches(t, 'password|secret|akia') then 'SECRET' when contains(t, '@') then 'CONTACT' when regexp_matches(t, 'license|copyright') then 'LICENSE' when contains(t, '|') then 'TABLE' when regexp_matches(t, '[0-9]{3}') then 'NUMBERS' else 'OTHER' end as class, count(*) as n from (select lower(text) as t from documents) group by 1",
    "content_digest": "select doc_id, s as sha256, strlen(text)::bigint as bytes, count(*) over (partition by s) as copies from (select doc_id, text, sha256(text) as s from documents)",
    "content_audit": "select case when doc_id % 35 = 0 then 'absent' else concat_ws(',', case when text = '' then 'empty' end, case when doc_id % 10 = 0 then 'length' end, case when doc_id % 15 = 0 then 'sha256' end, case when not contains(decode(encode(text)[1:64]::blob, 'ignore'), 'e') then 'magic' end) end as differences, count(*) as n from documents where text is not null group by 1",
    "artifact_records": "with l as (select distinct l_orderkey as k, l_linenumber as n from lineitem), g as (select k, count(*) = 3 and min(n) = 1 and max(n) = 3 as whole from l group by 1) select concat_ws(',', case when not whole then 'name_set' end, case k % 40 when 5 then 'path_blank' when 6 then 'file_missing' when 7 then 'size_differs' when 8 then 'digest_differs' end) as failures, count(*) as n from g group by 1",
    "canonical_digest": """select p_partkey, stored, sha256(stored) as sha256, p_partkey % 7 > 1 as is_canonical from (select p_partkey, case p_partkey % 7 when 0 then replace(j, '","p_', '", "p_') when 1 then replace(j, chr(10), '') else j end as stored
  from (select p_partkey, '{"p_name":"' || p_name || '","p_partkey":' || p_partkey::varchar || ',"p_size":' || p_size::varchar || '}' || chr(10) as j from part))""",
    "group_digest": f"select * from {GROUP_DIGEST}",
    "digest_binding": "select count(*) filter (k % 11 <> 0) as compared, count(*) filter (k % 11 <> 0 and k % 10 = 0) as mismatches, count(*) filter (k % 11 = 0) as one_sided from (select distinct o_custkey as k from orders where o_orderkey in (select l_orderkey from lineitem))",
    "manifest_chain": """with o as (select o_orderkey as k, o_custkey as c, o_custkey in (select c_custkey from customer) as known from orders),
  r as (select *, case when k % 100 = 10 then '-1' else c::varchar end as parent, case when c % 20 = 1 then '0' else 'right' || c::varchar end as said from o where known and k % 100 <> 9),
  d as (select parent from r group by 1 having count(distinct said) > 1)
  select 'nation' as kind, '' as failures, count(*) as n from nation
  union all select 'customer', concat_ws(',', case when c_custkey % 50 = 3 then 'version_differs' end, case when c_custkey % 50 = 4 then 'identity_differs' end), count(*) from customer group by 1, 2
  union all select 'order', concat_ws(',', case when r.k is null then 'parents_differ' end, case when r.parent = '-1' then 'parent_missing' end, case when r.parent <> '-1' and r.c % 20 = 1 then 'digest_differs' end, case when r.parent <> '-1' and r.c % 50 = 4 then 'identity_differs' end,
    case when r.parent in (select parent from d) then 'references_disagree' end), count(*) from o left join r using (k) group by 1, 2""",
    "collection_digests": """with x as (select l_orderkey as k, l_linenumber as no, case when l_orderkey % 30 = 4 and l_linenumber = 1 then 'none' else sha256(l_linenumber || ':' || l_partkey || ':' || l_quantity::bigint) end as c, case when l_orderkey % 30 = 5 and l_linenumber = 1 then 0 else l_quantity::bigint end as z
        from lineitem where not (l_orderkey % 30 = 3 and l_linenumber = 1)),
      p as (select k, no, count(*) as n, min(c || ':' || z) as low, max(c || ':' || z) as high from x group by 1, 2),
      d as (select k, sha256(string_agg(case when n = 1 then low else low || '#' || high || '#' || n end, ';' order by no)) as h, sum(n)::bigint as entries, count(*) as places, min(no) as first, max(no) as last from p group by 1),
      s as (select k, sum(z)::bigint as total, count(*) filter (z <= 0) as bad_sizes, count(*) filter (c = 'none') as bad_digests from x group by 1)
      select k as l_orderkey, h as collection_sha256, entries as entry_count, total as total_bytes, bad_sizes, bad_digests, entries + last - 2 * places + abs(first - 1) as bad_places, sha256(k || '|' || h) as run_id from d join s using (k)""",
    "model_events": """with d as (select user_id as u, event_id as e, event_type as m, row_number() over w as rn, lag(event_id) over w as before, epoch(date_trunc('second', ts))::bigint as t from events window w as (partition by user_id order by ts, event_id)),
      l as (select *, rn + case when u % 8 = 1 and rn > 1 then 1 else 0 end as seq, case when m = 'error' and u % 8 = 2 then 'REVOKE' else 'ACTIVATE' end as kind, case when u % 8 = 3 and rn = 3 then '?' else before::varchar end as prev,
        t + case when u % 8 = 4 and rn = 2 then 1 else 0 end as auth, t - case when u % 8 = 5 and rn = 2 then 1 else 0 end as eff from d),
      g as (select *, lag(e::varchar) over w as up, lag(t) over w as pub0, lag(eff) over w as eff0, lag(kind) over (partition by u, m order by seq) as kind0 from l window w as (partition by u order by seq)),
      c as (select u, count(*) filter (seq <> rn) as numbering, count(*) filter (prev is distinct from up) as chain, count(*) filter (t < pub0) as published_order, count(*) filter (eff < eff0) as effective_order,
        count(*) filter (not auth <= t) as authorized_late, count(*) filter (not t <= eff) as effective_early, count(*) filter (kind0 = 'REVOKE') as after_end, count(*) - count(distinct e) as repeated_ids from g group by 1)
      select u as user_id, * exclude (u), concat_ws(',', case when numbering > 0 then 'numbering' end, case when chain > 0 then 'chain' end, case when published_order > 0 then 'published_order' end, case when effective_order > 0 then 'effective_order' end, case when authorized_late > 0 then 'authorized_late' end,
        case when effective_early > 0 then 'effective_early' end, case when after_end > 0 then 'after_end' end, case when repeated_ids > 0 then 'repeated_ids' end) as failures,
        case when numbering + chain + published_order + effective_order + authorized_late + effective_early + after_end + repeated_ids = 0 then 'SUCCESS' else 'FAILED' end as status from c""",
    "publish_status": "select case when o_orderkey % 2 <> 0 then 'CREATED' when o_orderkey % 10 = 0 then 'CONFLICT' else 'VALIDATED_REUSE' end as publish, count(*) as n from orders group by 1",
    "package_audit": """with u as (select user_id, list_sort(list(distinct event_type)) = ['click', 'error', 'purchase', 'signup', 'view'] as whole, bool_or(event_type in ('view', 'click')) as bound from events group by 1),
  f as (select user_id, concat_ws(',', case when not whole then 'file_set' end, case when bound and user_id % 10 = 1 then 'binding_differs' end, case when user_id % 10 = 4 then 'approval_count' end, case when user_id % 10 = 2 then 'not_approved' end, case when user_id % 10 = 3 then 'not_active' end) as failures from u)
  select user_id, failures, case when failures = '' then 'SUCCESS' else 'FAILED' end as status from f""",
    "feature_build": "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_returnflag from lineitem where l_orderkey in (select l_orderkey from lineitem group by 1 having count(*) = count(distinct l_linenumber) and min(l_linenumber) = 1 and max(l_linenumber) = count(*) and bool_and(l_quantity between 1 and 50 and l_quantity = floor(l_quantity) and l_discount between 0 and 0.1 and l_tax between 0 and 0.08)) and l_orderkey in (select o_orderkey from orders)",
    "feature_audit": "select count(*) as rows, count(*) % 6 as rows_beyond_sixes, count(*) filter (l_quantity is null) as l_quantity_nulls, count(*) filter (l_extendedprice is null) as l_extendedprice_nulls, count(*) filter (l_discount is null) as l_discount_nulls, count(*) filter (l_tax is null) as l_tax_nulls, count(*) filter (not (isfinite(l_quantity) and isfinite(l_extendedprice) and isfinite(l_discount) and isfinite(l_tax))) as non_finite, (select count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)) as dup_keys from lineitem",
    "matrix_meaning": """with d as (select strftime(o_orderdate, '%Y-%m-%d') as race_date, o_custkey % 24 + 1 as v, l_orderkey as r, l_linenumber as b, l_partkey, l_suppkey, l_extendedprice from lineitem join orders on l_orderkey = o_orderkey),
      w as (select *, lag(v) over x as v0, lag(r) over x as r0, lag(b) over x as b0 from d window x as (partition by race_date order by r, b, l_partkey, l_suppkey, l_extendedprice)),
      g as (select race_date, count(*) as rows, (count(*) % 6 <> 0)::bigint as row_count, count(*) filter (r % 60 = 3) as nulls, count(*) filter (r % 60 in (1, 2)) as not_finite, count(*) filter (v0 is not null and (v0, r0, b0) >= (v, r, b)) as order_, count(*) - count(distinct (v, r, b)) as repeated_keys from w group by 1)
      select race_date, rows, row_count, nulls, not_finite, order_ as "order", repeated_keys, concat_ws(',', case when row_count <> 0 then 'row_count' end, case when nulls <> 0 then 'nulls' end, case when not_finite <> 0 then 'not_finite' end, case when order_ <> 0 then 'order' end, case when repeated_keys <> 0 then 'repeated_keys' end) as failures, case when abs(row_count) + abs(nulls) + abs(not_finite) + abs(order_) + abs(repeated_keys) = 0 then 'SUCCESS' else 'FAILED' end as status from g""",
    "snapshot_meaning": """with d as (select strftime(o_orderdate, '%Y-%m-%d') as race_date, o_orderkey % 200 as k from orders),
      g as (select race_date, count(*) as rows, count(*) filter (k in (1, 7)) as null_provenance, count(*) filter (k = 2) as invalid_timestamps, count(*) filter (k = 3) as future_source_rows, count(*) filter (k = 4) as source_alias_mismatches, count(*) filter (k = 5) as ineligible_status_rows,
        (count(distinct k = 6) <> 1)::bigint as source_digests, (count(distinct k = 7) <> 1)::bigint as deadline_digests from d group by 1)
      select *, concat_ws(',', case when null_provenance <> 0 then 'null_provenance' end, case when invalid_timestamps <> 0 then 'invalid_timestamps' end, case when future_source_rows <> 0 then 'future_source_rows' end, case when source_alias_mismatches <> 0 then 'source_alias_mismatches' end, case when ineligible_status_rows <> 0 then 'ineligible_status_rows' end, case when source_digests <> 0 then 'source_digests' end, case when deadline_digests <> 0 then 'deadline_digests' end) as failures, case when abs(null_provenance) + abs(invalid_timestamps) + abs(future_source_rows) + abs(source_alias_mismatches) + abs(ineligible_status_rows) + abs(source_digests) + abs(deadline_digests) = 0 then 'SUCCESS' else 'FAILED' end as status from g""",
    "one_hot": "select case l_returnflag when 'N' then 1 when 'R' then 2 else 0 end::int as flag_index, case l_linestatus when 'F' then 1 when 'O' then 2 else 0 end::int as state_index, count(*) as n from lineitem group by 1, 2",
    "logit_score": "select l_orderkey, l_linenumber, l_partkey, round(case when s >= 36 then 1.0 when s <= -36 then 0.0 else 1 / (1 + exp(-s)) end, 9) as p from (select *, -1.5 + 0.05 * l_quantity + (-12.0)::double * l_discount + 20.0::double * l_tax + 0.75::double * (case l_returnflag when 'N' then 1 when 'R' then 2 else 0 end) as s from lineitem)",
    "model_scores": """with g as (select p_brand as m, count(*) as n, sum(p_size)::bigint as size, min(p_partkey) % 9 as k from part group by 1),
      w as (select *, case k when 1 then 'not_finite' when 2 then 'coefficient_count' when 3 then 'feature_order' when 4 then 'repeated_entries' when 5 then 'unknown_model' end as refused from g),
      s as (select m, refused, (n % 5 - 2) / 2.0::double + (size % 13 - 6) / 64.0::double * l_quantity + (n % 11 - 5) / 4.0::double * l_discount + (size % 7) / 2.0::double * l_tax + case l_returnflag when 'N' then 0.5::double when 'R' then -0.25::double else 0.0::double end as z
        from lineitem join part on l_partkey = p_partkey join w on p_brand = m)
      select m as model_id, refused, count(*) as n, count(*) filter (refused is null) as scored, sum(case when refused is null then round(case when z >= 36 then 1.0 when z <= -36 then 0.0 else 1 / (1 + exp(-z)) end, 6)::decimal(18, 6) end)::double as expected from s group by 1, 2""",
    "model_rules": """with x as (select l_orderkey as k, count(*) as n, count(distinct l_partkey) as kinds, list_sort(list(distinct l_returnflag)) as c, list({n: l_linenumber, p: l_partkey, d: l_discount} order by l_linenumber, l_partkey, l_discount) as v from lineitem group by 1),
  f as (select *, list_transform(v, lambda q: q.p) as names from x)
  select concat_ws(',', case when k % 30 = 2 then 'coefficient_count' end, case when kinds < n then 'repeated_names' end, case when k % 30 = 1 then 'not_finite' end, case when not (len(c) = 2 and c[2] = 'R') then 'positive_class' end, case when k % 30 = 3 and n > 1 and names <> list_reverse(names) then 'feature_order' end) as failures, count(*) as n
  from f group by 1""",
}
