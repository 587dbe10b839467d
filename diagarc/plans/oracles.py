"""Plain SQL for the catalogue, written from the tables alone: no archive is involved."""

from __future__ import annotations

from diagarc.functions.scalar import I64_MAX, I64_MIN, REPLACED, SEPARATOR, WHITE_SPACE
from diagarc.operators.labels import SOURCE_LABEL
from diagarc.plans.catalog import AS_OF_MS, DOCS_PER_FILE, HOUR_MS, ODD_WINDOW_MS, SAMPLES_PER_DOC

_SOURCE = SOURCE_LABEL[1]
# Bytes of a base-128 number.
_VARINT = "(case " + " ".join(f"when %(n)s < {1 << 7 * i} then {i}" for i in range(1, 9)) + " else 9 end)"

# Fields of an event document: (name, BSON type, SQL value).
_FIELDS = [
    ("start", "datetime", "ms"), ("event_user_id", "int64", "user_id"), ("event_value", "double", "v"),
    ("event_is_error", "bool", "is_error"), ("event_props_k", "int64", "k"), ("end", "datetime", "ms"),
]


def _events(size=300):
    """CTEs: ``d`` one row per event with its chunk, ``c`` chunks, ``f`` fields, ``s`` samples."""
    fields = ", ".join(f"({i}::int, '{n}', '{t}')" for i, (n, t, _) in enumerate(_FIELDS))
    value = " ".join(f"when {i} then {v}" for i, (_, _, v) in enumerate(_FIELDS))
    return f"""
    with e as (
      select strftime(ts, '%Y-%m-%d') as path, epoch_us(ts) // 1000 as ms, event_id, user_id, event_type,
        trunc(value)::bigint as v, (event_type = 'error')::int::bigint as is_error,
        regexp_extract(props, '[0-9]+')::bigint as k
      from events),
    r as (select *, row_number() over (partition by path order by ms, event_id) - 1 as rn from e),
    d as (select *, rn // {size} as doc_no, (rn % {size})::int as sample_no from r),
    c as (select path, doc_no, min(ms) as id_ms, count(*)::bigint as n from d group by path, doc_no),
    f(key_no, name, bson_type) as (values {fields}),
    s as (select path, doc_no, key_no, name, bson_type, sample_no, ms as ts_ms,
        (case key_no {value} end)::bigint as value from d cross join f),
    g as (select *, value - lag(value) over (partition by path, doc_no, key_no order by sample_no) as delta from s)
    """


_E = _events()
_F = _events(SAMPLES_PER_DOC)
_SAMPLES = f"{_E} select path, doc_no, key_no, name, sample_no, ts_ms, value from s"
_FILE = f"doc_no // {DOCS_PER_FILE}"
_SERIES = f"""{_E} select path, doc_no, key_no, name, count(*)::bigint as n,
    string_agg(value::varchar, ',' order by sample_no) as value_list, max(ts_ms) as last_ms
    from s group by path, doc_no, key_no, name"""
_TOKENS = f"""{_E},
    cells as (select path, doc_no, delta, row_number() over (partition by path, doc_no order by key_no, sample_no) as cell
      from g where delta is not null),
    grouped as (select *, count(*) filter (where delta <> 0) over (partition by path, doc_no order by cell) as grp from cells),
    runs as (select path, doc_no, grp, max(delta) filter (where delta <> 0) as head,
      min(delta) filter (where delta <> 0) as head2, count(*) filter (where delta = 0) as zeros
      from grouped group by path, doc_no, grp),
    t as (
      select path, doc_no, grp, 0 as pos, head as token from runs where head is not null
      union all select path, doc_no, grp, 1, 0 from runs where zeros > 0
      union all select path, doc_no, grp, 2, zeros - 1 from runs where zeros > 0),
    tokens as (select path, doc_no, row_number() over (partition by path, doc_no order by grp, pos) - 1 as token_no,
      token::bigint as token from t)
    """
_WIDE = """
    with h as (select 'users-' || (user_id // 1000)::varchar as path, user_id, (epoch_us(ts) // 1000) // 3600000 as hour from events),
    n as (select path, hour // 300 as doc_no, user_id, hour % 300 as slot, count(*) as n from h group by all),
    u as (select distinct path, doc_no, user_id from n),
    grid as (select u.path, u.doc_no, u.user_id, r.slot, coalesce(n.n, 0)::bigint as n
      from u cross join range(300) r(slot) left join n on n.path = u.path and n.doc_no = u.doc_no
        and n.user_id = u.user_id and n.slot = r.slot),
    tot as (select *, sum(n) over (partition by path, doc_no, user_id order by slot)::bigint as total from grid),
    w as (
      select path, doc_no, 'u' || user_id::varchar || '_n' as name, slot, n as value from tot
      union all select path, doc_no, 'u' || user_id::varchar || '_total', slot, total from tot
      union all select p.path, p.doc_no, e.name, r.slot, (p.doc_no * 300 + r.slot) * 3600000
        from (select distinct path, doc_no from u) p cross join range(300) r(slot) cross join (values ('start'), ('end')) e(name))
    """
_CLEAN = f"translate(trim(raw, '{WHITE_SPACE}'), '{REPLACED}', '{SEPARATOR * len(REPLACED)}')"
_LABEL = f"trim(%s, '{WHITE_SPACE}')"
_USER = """
    with m as (select user_id, epoch_us(ts) // 1000 as ms, event_id, event_type,
        regexp_extract(props, '[0-9]+')::bigint as k from events),
    x as (select user_id, ms, event_id, event_type as type, (k // 50)::varchar as half, k % 10 = 0 as tag from m),
    p as (select *, lag(type) over w as type0, lag(half) over w as half0, lag(tag) over w as tag0
      from x window w as (partition by user_id order by ms, event_id)),
    q as (select *, tag0 is null or tag <> tag0 as reset, (type <> type0) as type_new, (half <> half0) as half_new from p),
    y as (select *, (not reset and (type_new or half_new))::int as hit from q),
    z as (select *, sum(hit) over (partition by user_id order by ms, event_id) as hits from y),
    b as (select *, hits - max(case when reset then hits end) over (partition by user_id order by ms, event_id
        rows unbounded preceding) as idx from z),
    o as (select *, case when reset then 0 else 2 end as doc_type from b where reset or hit = 1)
    """
_AS_OF = f"""{_USER},
    l as (select user_id, arg_max(ms, row(ms, event_id)) as ms, arg_max(type, row(ms, event_id)) as type,
      arg_max(half, row(ms, event_id)) as half, bool_or(reset and tag) as tag from o where ms <= {AS_OF_MS} group by user_id),
    a as (select user_id, 'start' as name, ms::varchar as value from l
      union all select user_id, 'end', (ms + 1)::varchar from l
      union all select user_id, 'type', type from l
      union all select user_id, 'half', half from l
      union all select user_id, 'tag', 'x' from l where tag)
    """
_REQUESTS = f"""{_E} select path, doc_no, key_no, '__name__=' || name || ',source={_SOURCE},host=h1' as labels,
    count(*)::bigint as n, sum(value)::double as sum_value, min(ts_ms) as first_ms, max(ts_ms) as last_ms
    from s group by path, doc_no, key_no, name"""
_DAY_FILE = f"path as day, {_FILE} as file_no, doc_no % {DOCS_PER_FILE} as doc_no"
_LABELLED = f"case when event_type = 'error' then 'other' else '{_SOURCE}' end"


def _rollup(samples, width):
    """Windows over dense samples ``samples`` (path, doc_no, name, sample_no, ts_ms, value): each holds until the next."""
    return f"""
    ho as (select *, lead(ts_ms) over (partition by path, doc_no, name order by sample_no) as next_ms from {samples}),
    pa as (select *, unnest(range((ts_ms // {width}) * {width},
        greatest(ts_ms, coalesce(next_ms - 1, ts_ms)) + 1, {width})) as window_ms from ho),
    qa as (select *, greatest(ts_ms, window_ms) as from_ms,
        greatest(ts_ms, window_ms, least(coalesce(next_ms, ts_ms), window_ms + {width})) as to_ms from pa)
    select path, name, window_ms, sum(to_ms - from_ms)::bigint as held_ms,
      sum(value::hugeint * (to_ms - from_ms))::double / nullif(sum(to_ms - from_ms), 0)::double as mean_value,
      min(value)::bigint as min_value, max(value)::bigint as max_value,
      last(value order by to_ms, doc_no, sample_no)::bigint as last_value
    from qa group by path, name, window_ms"""


ORACLES = {
    "archive_samples": _SAMPLES,
    "archive_daily_avg": f"{_E} select path, name, count(*)::bigint as n, avg(value) as avg_value from s group by path, name",
    "named_samples": f"""{_E} select path, doc_no, key_no, name, sample_no, ts_ms, value from s
        where name in ('event_value', 'event_props_k')""",
    "wide_samples": f"""{_WIDE} select path, doc_no, name, count(*)::bigint as n, sum(value)::bigint as sum_value,
        max(value)::bigint as max_value, min((doc_no * 300 + slot) * 3600000)::bigint as first_ms,
        max((doc_no * 300 + slot) * 3600000)::bigint as last_ms from w group by path, doc_no, name""",
    "sparse_summary": f"""{_E} select path, doc_no, name, sum(value)::bigint as sum_value, count(*)::bigint as n,
        min(value) as min_value, max(value) as max_value, count(*) filter (where delta is null or delta <> 0)::bigint as n_runs
        from g group by path, doc_no, name""",
    "rollup_hours": f"{_E}, {_rollup('s', HOUR_MS)}",
    "rollup_wide": f"""{_WIDE}, v as (select path, doc_no, name, slot as sample_no,
        ((doc_no * 300 + slot) * 3600000)::bigint as ts_ms, value from w), {_rollup('v', ODD_WINDOW_MS)}""",
    "schema_change_samples": f"""{_E},
        x as (select *, event_type = 'error' as bare from e),
        y as (select *, bare is distinct from lag(bare) over (partition by path order by ms, event_id) as new from x),
        z as (select *, sum(new::int) over (partition by path order by ms, event_id) as seg from y),
        n as (select *, ((row_number() over (partition by path, seg order by ms, event_id) - 1) % 300)::int as no from z),
        m as (select *, sum((no = 0)::int) over (partition by path order by ms, event_id) - 1 as doc from n)
        select path, doc::bigint as doc_no, (case when name = 'end' and bare then 2 else i end)::int as key_no, name, no as sample_no,
          ms as ts_ms, (case i when 1 then user_id when 2 then k else ms end)::bigint as value
        from m cross join (values (0, 'start'), (1, 'event_user_id'), (2, 'event_props_k'), (3, 'end')) f(i, name)
        where not (bare and i = 2)""",
    "varint_tokens": f"{_TOKENS} select * from tokens",
    "decode_chunk_heads": f"""{_E} select path, doc_no, id_ms, 6::bigint as n_keys, n - 1 as n_deltas,
        6::bigint as n_keys_found, (id_ms // 60000) % 4 <> 1 as sizes_match from c""",
    "decoded_keys": f"""{_E},
        bases as materialized (select path, doc_no, key_no, name, bson_type, value from s where sample_no = 0),
        points as materialized (select path, doc_no, key_no, sample_no, delta from g where delta <> 0)
        select b.path, b.doc_no, b.key_no, b.name, b.bson_type, b.value as base, p.sample_no, p.delta
        from bases b left join points p on p.path = b.path and p.doc_no = b.doc_no and p.key_no = b.key_no""",
    "expand_zero_runs": f"{_E} select path, doc_no, key_no, sample_no, delta from g where delta <> 0",
    "stream_complete": f"""{_E} select path, case right(path, 2)::int % 3 when 1 then case when n > 1 then 'bad_varint' end
        when 2 then 'tokens_left' end as error, count(*)::bigint as n_chunks from c group by all""",
    "delta_decode": f"""{_E} select path, doc_no, key_no, name, sample_no, value from g where delta is null or delta <> 0""",
    "densify": f"{_E} select path, doc_no, key_no, name, sample_no, value from s",
    "time_axis": _SAMPLES,
    "series_rows": _SERIES,
    "series_of_samples": _SERIES,
    "samples_of_series": _SAMPLES,
    "flatten_struct_keys": f"{_E} select event_id, key_no, name, bson_type, (case key_no "
        + " ".join(f"when {i} then {v}" for i, (_, _, v) in enumerate(_FIELDS))
        + " end)::bigint as value from d cross join f",
    "flatten_array_keys": """select vec_id, 0 as key_no, 'vec_data_label' as name, 'int32' as bson_type, label::bigint as value
        from embeddings union all
        select vec_id, i::int, 'vec_data_e_' || (i - 1)::varchar, 'double', trunc(embedding[i]::double * 1000)::bigint
        from (select vec_id, embedding, unnest(range(1, len(embedding) + 1)) as i from embeddings)""",
    "clean_key_names": f"""with x as (select '  p.(' || p_name || ')-,' || p_brand || chr(12288) as raw from part
        union all select text from documents union all select url from pages)
        select {_CLEAN} as clean, count(*)::bigint as n from x group by 1""",
    "to_i64": f"""select l_orderkey, l_partkey, l_suppkey, l_linenumber, case l_linenumber when 1 then 0
        when 2 then {I64_MAX} when 3 then ({I64_MIN + 1} - 1) when 4 then trunc(-l_extendedprice)::bigint
        else trunc(l_extendedprice)::bigint end::bigint as v from lineitem""",
    "split_timestamps": """select event_id, 'oplog_t' as name, (epoch_us(ts) // 1000000)::bigint as value from events
        union all select event_id, 'oplog_i', user_id from events
        union all select event_id, 'stored_t', 0 from events union all select event_id, 'stored_i', 0 from events""",
    "delta_encode": """select event_type, event_id, user_id, user_id - lag(user_id) over (partition by event_type
        order by epoch_us(ts) // 1000, event_id) as delta from events""",
    "zero_run_encode": f"{_TOKENS} select * from tokens",
    "varint_size": f"""{_TOKENS} select path, count(*)::bigint as n_tokens, sum(case when token < 0 then 10 """
        + " ".join(f"when token < {1 << 7 * n} then {n}" for n in range(1, 9))
        + " else 9 end)::bigint as n_bytes, (count(*) * 8)::bigint as n_word_bytes from tokens group by path",
    "chunk_boundaries": """with x as (select user_id % 3 as source, event_id, event_type, epoch_us(ts) // 1000 as ms from events),
        a as (select *, event_type is distinct from lag(event_type) over (partition by source order by ms, event_id) as new from x),
        b as (select *, sum(new::int) over (partition by source order by ms, event_id) as seg from a),
        c as (select *, (row_number() over (partition by source, seg order by ms, event_id) - 1) % 2 as sample_no from b)
        select source, event_id, (sum((sample_no = 0)::int) over (partition by source order by ms, event_id) - 1)::bigint as doc_no,
        sample_no::int as sample_no from c""",
    "read_archives": f"""{_F} select {_DAY_FILE}, 1 as doc_type, id_ms, doc_no % {DOCS_PER_FILE} = 0 as is_first from c""",
    "file_samples": f"{_F} select {_DAY_FILE}, key_no, name, sample_no, ts_ms, value from s",
    "archive_file_time": f"""{_F} select path as day, id_ms // 1000 * 1000 as file_ms, {_FILE} as uniquifier from c
        where doc_no % {DOCS_PER_FILE} = 0 and id_ms >= 1704844800000""",
    "first_metric_docs": f"""{_F} select {_DAY_FILE}, id_ms, id_ms as json_ms from c where doc_no % {DOCS_PER_FILE} = 0""",
    "metric_docs": f"""{_E} select path, count(*)::bigint as n_docs, min(id_ms) as first_ms from c group by path""",
    "doc_outline": f"""{_E}, l as (
        select path, doc_no, 0 as ord, 0 as depth, 'start' as key, 'datetime' as type,
          strftime(make_timestamp(ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') as preview from d where sample_no = 0
        union all select path, doc_no, 1, 0, 'event', 'document', null from d where sample_no = 0
        union all select path, doc_no, 2, 1, 'user_id', 'int64', user_id::varchar from d where sample_no = 0
        union all select path, doc_no, 3, 1, 'value', 'double', v::varchar from d where sample_no = 0
        union all select path, doc_no, 4, 1, 'is_error', 'bool', (is_error = 1)::varchar from d where sample_no = 0
        union all select path, doc_no, 5, 1, 'props', 'document', null from d where sample_no = 0
        union all select path, doc_no, 6, 2, 'k', 'int64', k::varchar from d where sample_no = 0
        union all select path, doc_no, 7, 0, 'end', 'datetime',
          strftime(make_timestamp(ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') from d where sample_no = 0) select * from l""",
    "doc_types": f"""select * from ({_E} select 1 as doc_type, count(*)::bigint as n_docs, max(id_ms) as last_ms from c)
        union all select * from ({_USER} select doc_type, count(*)::bigint, max(ms) from o group by doc_type)""",
    "route_docs_by_kind": f"""select * from ({_E} select 'metric' as kind, count(*)::bigint as n_docs,
          count(distinct path)::bigint as n_paths from c)
        union all select * from ({_USER} select case doc_type when 0 then 'metadata' else 'delta' end, count(*)::bigint,
          count(distinct user_id)::bigint from o group by doc_type)""",
    "decode_error_classes": f"""{_E} select case (id_ms // 60000) % 4 when 1 then 'bad_bson' when 2 then 'not_metric'
        else 'no_data' end as error_class, count(*)::bigint as n_rows from c where (id_ms // 60000) % 4 <> 0 group by 1""",
    "damaged_import": f"""{_E}, x as (select *, case (id_ms // 60000) % 4 when 1 then 'bad_bson' when 2 then 'not_metric'
          when 3 then 'no_data' end as class from c)
        select 'n_chunks' as kind, count(*)::bigint as n from x where class is null
        union all select 'n_errors', count(*)::bigint from x where class is not null
        union all select 'stored ' || f.name, count(*)::bigint from x cross join f where class is null group by f.name
        union all select class, count(*)::bigint from x where class is not null group by class""",
    "split_archive_samples": f"""{_F}, first as (select path as p, doc_no as n, min(ts_ms) as first_ms from s group by all)
      select path as day, {_FILE} as file_no, key_no, name, sample_no, ts_ms, value from s join first on p = path and n = doc_no
      where first_ms >= 1704844800000""",
    "growing_archive_samples": f"{_F} select path as day, {_FILE} as file_no, key_no, name, sample_no, ts_ms, value from s",
    "stream_archive_samples": f"{_F} select {_DAY_FILE}, key_no, name, sample_no, ts_ms, value, path as date from s",
    "parse_labels": f"""with raw as (
        select unnest([' ' || event_type || ' =' || chr(9) || props, event_type || '=a=b=', props, ' = ' || props, event_type || '='])
          as raw from events union all select source || ' = ' || text from documents),
        p as (select raw, strpos(raw, '=') as eq from raw),
        t as (select case when eq > 0 then {_LABEL % "left(raw, eq - 1)"} end as name,
          {_LABEL % "substr(raw, eq + 1)"} as value, eq from p),
        v as (select case when name <> '' then name end as label_name, case when name <> '' then value end as label_value,
          case when eq = 0 then 'missing ''=''' when name = '' then 'empty name' end as reason from t)
        select label_name, label_value, reason, count(*)::bigint as n from v group by all""",
    "with_labels": f"""{_E}, k as (select path, doc_no, key_no, name from s where sample_no = 0)
        select path, doc_no, key_no, 0 as label_no, '__name__' as label, name as value from k
        union all select path, doc_no, key_no, 1, 'source', '{_SOURCE}' from k
        union all select path, doc_no, key_no, 2, 'host', 'a=1' from k
        union all select path, doc_no, key_no, 3, 'host', 'b' from k""",
    "write_request_rows": _REQUESTS,
    "requests_of_series": _REQUESTS,
    "remote_write_receipts": f"""{_E},
        x as (select path, doc_no, name, 2 + (4 + length('__name__') + length(name)) + 2 + (4 + length('source') + length('{_SOURCE}'))
            + sum(12 + {_VARINT % {"n": "ts_ms"}}) as size from s group by path, doc_no, name)
        select path, doc_no, count(*)::bigint as n_series, sum(1 + {_VARINT % {"n": "size"}} + size)::bigint as n_plain_bytes,
          204 as status from x group by path, doc_no""",
    "write_samples": f"""{_E} select '{_SOURCE}' as source, path as date, name, count(*)::bigint as n,
        sum(value)::bigint as sum_value from s group by path, name""",
    "write_series": _SAMPLES,
    "delete_series": f"""select {_LABELLED} as source, event_type as name, count(*)::bigint as n, sum(user_id)::bigint as sum_value
        from events where event_type = 'error' group by 1, 2""",
    "delete_labelled_series": f"""select {_LABELLED} as source, event_type as name, count(*)::bigint as n,
        sum(user_id)::bigint as sum_value from events where event_type <> 'click' group by 1, 2""",
    "reimport": f"""select 'other' as source, 'error' as name, count(*)::bigint as n, sum(user_id)::bigint as sum_value
        from events where event_type = 'error' union all
        select * from ({_E} select '{_SOURCE}', name, count(*)::bigint, sum(value)::bigint from s
        group by name)""",
    "import_summary": f"{_E} select count(*)::bigint as n_chunks, (6 * count(*))::bigint as n_series from c",
    "check_totals": f"""{_E} select count(distinct (path, doc_no))::bigint as n_chunks, count(*)::bigint as n_series,
        count(distinct name)::bigint as n_names from s where sample_no = 0""",
    "metric_examples": f"""{_E}, l as (select path, doc_no, n from c order by path desc, doc_no desc limit 1)
        select s.name, l.n as n_samples, s.value as first_value from s join l on s.path = l.path and s.doc_no = l.doc_no
        where s.sample_no = 0 order by s.name limit 10""",
    "metric_names": f"""{_WIDE}, names as (select distinct name from w)
        select row_number() over (order by name) as name_no, name from names""",
    "import_progress": f"""{_E} select path, doc_no, count(*) over w as n_chunks, (6 * count(*) over w)::bigint as n_series,
        n as n_samples from c window w as (partition by path order by doc_no)""",
    "type_distribution": f"""{_E} select bson_type, count(*)::bigint as n_series from s where sample_no = 0 group by bson_type""",
    "axis_audit": f"""{_E},
        o as (select path, ms, row_number() over (partition by path order by event_id % 7, event_id) - 1 as rn from e),
        a as (select path, rn // 300 as doc_no, rn, ms, ms - lag(ms) over (partition by path, rn // 300 order by rn) as step from o)
        select path, doc_no, count(*)::bigint as n_samples, arg_min(ms, rn) as first_ms, arg_max(ms, rn) as last_ms,
        count(*) filter (where step <= 0)::bigint as n_violations, arg_max(ms, rn) - arg_min(ms, rn) as span_ms,
        (arg_max(ms, rn) - arg_min(ms, rn))::double / nullif(count(*) - 1, 0) as mean_step_ms from a group by path, doc_no""",
    "shape_audit": f"""{_E} select path, doc_no, 6::bigint as n_keys, 6::bigint as n_keys_found, n as n_samples,
        6 * (n - 1) as n_cells, true as keys_match from c""",
    "verify_stored": f"""{_E} select path, doc_no, 6::bigint as n_keys_found, 5::bigint as stored_series from c
        where path = '2024-01-05'""",
    "metadata_delta": f"""{_USER} select user_id, event_id, doc_type, idx::bigint as index,
        'start=' || ms::varchar || case when reset or type_new then ',type=' || type else '' end
        || case when reset or half_new then ',half=' || half else '' end || ',end=' || (ms + 1)::varchar
        || case when reset and tag then ',tag=x' else '' end as fields from o""",
    "metadata_as_of": f"{_AS_OF} select user_id, name, value from a",
    "metadata_as_of_archive": f"{_AS_OF} select 'user-' || user_id::varchar as path, name, value from a",
    "metadata_history": f"""{_USER} select user_id, event_id, type, half, case when bool_or(reset and tag) over (
        partition by user_id order by ms, event_id rows unbounded preceding) then 'x' end as tag from o""",
}
