"""The registered queries in DuckDB SQL, stated on the raw views directly.

Written from the rules, not from the Spark expressions: where Spark reads files,
streams or JSON, the SQL says what must come out of them.
"""

from __future__ import annotations

from callweave.plans.raw_views import raw_sql

RUN_TS = "2024-06-01 00:00:00"

COLUMNS = {
    "cdr": ["caller_id", "callee_id", "call_start", "call_duration", "call_type", "cell_id", "location", "imei",
            "is_fraud"],
    "ipdr": ["user_id", "timestamp", "domain", "ip_dst", "port", "protocol", "duration", "bytes_sent",
             "bytes_received", "vpn_usage", "is_fraud"],
    "edr": ["event_id", "user_id", "device_model", "os_type", "roaming_status", "network_type", "event_time",
            "location", "event_type", "is_fraud"],
}
TIMES = {"cdr": "call_start", "ipdr": "timestamp", "edr": "event_time"}
FLAGS = ("vpn_usage", "roaming_status", "is_fraud")
NUMBERS = ("call_duration", "port", "duration", "bytes_sent", "bytes_received")
KEYS = {
    "cdr": ["caller_id", "callee_id", "call_start"],
    "ipdr": ["user_id", "timestamp", "domain"],
    "edr": ["event_id", "user_id", "event_time"],
}
FOREIGN = {"cdr": "cell_id = 'CELL_777'", "ipdr": "duration = '50'", "edr": "user_id = '100000000007'"}
DOUBLED = {"cdr": "imei", "ipdr": "domain", "edr": "event_type"}
DEFAULTS = {"protocol": "TCP", "call_type": "voice_in", "event_type": "app_launch", "network_type": "4G",
            "os_type": "Android"}
KINDS = ("cdr", "ipdr", "edr")


def q(name: str) -> str:
    return f'"{name}"'


def std_time(c: str) -> str:
    v = f"trim({c}, ' ')"
    return f"""coalesce(strftime(coalesce(
        try_strptime({v}, ['%Y-%m-%d %H:%M:%S', '%d/%m/%Y %H:%M:%S', '%m/%d/%Y %H:%M:%S', '%Y-%m-%dT%H:%M:%S.%fZ']),
        case when regexp_matches({v}, '^[+-]?[0-9]+([.][0-9]*)?$')
             then make_timestamp(cast(try_cast({v} as double) * 1000000 as bigint)) end),
        '%Y-%m-%d %H:%M:%S'), {v})"""


def std_flag(c: str) -> str:
    v = f"lower(trim({c}, ' '))"
    return f"""case when {v} in ('true', 't', 'yes', 'y', '1') then true
        when {v} in ('false', 'f', 'no', 'n', '0') then false
        when regexp_matches({v}, '^[+-]?[0-9]+$') then try_cast({v} as hugeint) <> 0 end"""


def loose_flag(c: str) -> str:
    return f"coalesce(lower({c}) in ('true', 't', 'yes', 'y', '1'), false)"


def tidy_time(c: str) -> str:
    """Only the canonical form counts."""
    return (
        f"case when regexp_matches({c}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}$')"
        f" then {c} end"
    )


def number(c: str) -> str:
    """Cut a fraction; anything else is 0."""
    return f"""coalesce(case when regexp_matches({c}, '^[+-]?[0-9]+([.][0-9]*)?$')
        then try_cast(split_part({c}, '.', 1) as integer) end, 0)"""


def digits(c: str, default: str = "0") -> str:
    return f"coalesce(case when regexp_matches({c}, '^[+-]?[0-9]+$') then try_cast({c} as integer) end, {default})"


def published_number(c: str, default: str) -> str:
    """Cut a fraction; 64 bits."""
    return f"""coalesce(case when regexp_matches({c}, '^[+-]?[0-9]+([.][0-9]*)?$')
        then try_cast(split_part({c}, '.', 1) as bigint) end, {default})"""


def scrubbed(c: str, default: str) -> str:
    return f"""case when {c} is null or trim({c}, ' ') = '' or lower({c}) in ('nan', '"nan"') then '{default}'
        else trim(regexp_replace(lower({c}), '^"|"$', '', 'g'), ' ') end"""


def listed(value: str, words: str, default: str) -> str:
    return f"case when {value} in ({words}) then {value} else '{default}' end"


ENUM_WORDS = {
    "call_type": ("'voice_in', 'voice_out', 'sms_in', 'sms_out'", "voice_in"),
    "protocol": ("'tcp', 'udp'", "tcp"),
    "event_type": ("'app_launch', 'login', 'logout', 'payment', 'sim switch', 'roaming event', 'reboot'", "app_launch"),
    "network_type": ("'4g', '5g', '3g', 'wifi', 'lte'", "4g"),
}
# spellings without a capital are all a lower-cased value can equal
REFERENCE_WORDS = {
    "call_type": ENUM_WORDS["call_type"],
    "protocol": ("'-'", "tcp"),
    "event_type": ("'app_launch', 'login', 'logout', 'payment', 'roaming event', 'reboot'", "app_launch"),
    "network_type": ("'-'", "4g"),
}
ENUM_KIND = {"call_type": "cdr", "protocol": "ipdr", "event_type": "edr", "network_type": "edr"}


def standard(kind: str, source: str, doubled_null: bool = False, keep: str = "") -> str:
    """Standard rows: names mapped, times and flags in one form."""
    parts = [keep] if keep else []
    for c in COLUMNS[kind]:
        value = q(c)
        if doubled_null and c == DOUBLED[kind]:
            value = f"case when rid % 11 = 0 then null else {value} end"
        if c == TIMES[kind]:
            value = std_time(value)
        elif c in FLAGS:
            value = std_flag(value)
        parts.append(f"{value} as {q(c)}")
    return f"select {', '.join(parts)} from ({source}) s"


def batch_clean(kind: str, source: str, extra: str = "", fold: bool = False) -> str:
    """Batch cleaning of standard rows (flags already boolean or null)."""
    parts = []
    for c in COLUMNS[kind]:
        if c == TIMES[kind]:
            value = f"coalesce({tidy_time(q(c))}, '{RUN_TS}')"
        elif c in FLAGS:
            value = f"coalesce({q(c)}, false)"
        elif c in NUMBERS:
            value = number(q(c))
        else:
            default = DEFAULTS.get(c, "unknown")
            value = scrubbed(q(c), default.lower() if fold else default)
            if c in KEYS[kind]:
                value = f"coalesce(nullif({value}, 'unknown'), 'default_{c.removesuffix('_id')}')"
            elif c == "call_type":
                words, fallback = ENUM_WORDS[c]
                value = listed(f"({value})", words, fallback)
        parts.append(f"{value} as {q(c)}")
    return f"select {', '.join(parts)}{extra} from ({source}) b"


def cleaned(kind: str) -> str:
    return batch_clean(kind, standard(kind, raw_sql(kind, copies=True)))


def clean_table(kind: str) -> str:
    return f"select distinct * from ({cleaned(kind)}) d"


def message_values(kind: str) -> str:
    """Columns as the messages carry them; nothing comes out of a body that is cut off."""
    parts = []
    for c in COLUMNS[kind]:
        if c == TIMES[kind]:
            value = f"case when rid % 7 < 4 then tidy_time else {q(c)} end"
        elif c in FLAGS:
            value = std_flag(q(c))
        elif c in NUMBERS:
            value = digits(q(c), "null")
        else:
            value = q(c)
        parts.append(f"{value} as {q(c)}")
    return f"select rid, rid % 13 = 0 as broken, {', '.join(parts)} from ({raw_sql(kind, copies=True)}) m"


def live_values(kind: str, match: str) -> str:
    parts = []
    for c in COLUMNS[kind]:
        value = q(c)
        if c == TIMES[kind]:
            value = tidy_time(value)
        elif c in FLAGS:
            value = f"coalesce({value}, false)"
        elif c in NUMBERS and kind == "ipdr":
            value = f"coalesce({value}, 0)"
        elif c in ENUM_WORDS:
            words, fallback = (ENUM_WORDS if match == "casefold" else REFERENCE_WORDS)[c]
            value = listed(f"lower({value})", words, fallback)
        parts.append(f"{value} as {q(c)}")
    return f"select broken, {', '.join(parts)} from ({message_values(kind)}) v"


def live_table(kind: str, match: str = "casefold") -> str:
    names = ", ".join(q(c) for c in COLUMNS[kind])
    required = " and ".join(f"trim({q(c)}, ' ') <> ''" for c in KEYS[kind])
    return f"select distinct {names} from ({live_values(kind, match)}) l where not broken and {required}"


def published(kind: str) -> str:
    parts = []
    for c in COLUMNS[kind]:
        text = f"trim(lower(nullif({q(c)}, '')), ' ')"
        if c in FLAGS:
            value = f"{text} in ('true', 't', '1', 'yes')"
        elif c in ENUM_WORDS:
            words, fallback = ENUM_WORDS[c]
            value = listed(text, words.replace(", 'reboot'", ""), fallback)
        elif c in NUMBERS:
            value = published_number(text, "0" if kind == "ipdr" else "null")
        else:
            value = text
        parts.append(f"{q(c)}: {value}")
    body = "{" + ", ".join(parts) + "}"
    return f"""select '{kind}' as topic, cast(to_json({body}) as varchar) as value,
        (select count(*) from ({raw_sql(kind)}) r) as records_sent from ({raw_sql(kind)}) p"""


def timeline_rows() -> str:
    parts = []
    for rank, kind in enumerate(KINDS):
        body = "{" + ", ".join(f"{q(c)}: {q(c)}" for c in COLUMNS[kind]) + "}"
        who = "caller_id" if kind == "cdr" else "user_id"
        parts.append(
            f"select {who} as subscriber, {q(TIMES[kind])} as ts, '{kind}' as source, {rank} as source_rank,"
            f" is_fraud, cast(to_json({body}) as varchar) as payload from ({clean_table(kind)}) t"
        )
    return " union all ".join(parts)


def coverage(kind: str) -> str:
    rows = standard(kind, f"select * from ({raw_sql(kind)}) r where not coalesce({FOREIGN[kind]}, false)", True)
    return " union all ".join(
        f"select '{c}' as field, count({q(c)}) / count(*) * 100.0 as coverage from ({rows}) c" for c in COLUMNS[kind]
    )


def per_kind(template) -> str:
    return " union all ".join(template(kind) for kind in KINDS)


def not_foreign(kind: str) -> str:
    return f"select * from ({raw_sql(kind)}) r where not coalesce({FOREIGN[kind]}, false)"


def wide(policy: str) -> str:
    event = (
        "case when rid % 2 = 1 then event_type end" if policy == "first_present" else "event_type"
    )
    nulls = ", ".join(
        f"cast(null as {'boolean' if c in FLAGS else 'varchar'}) as {c}"
        for c in ("event_id", "device_model", "roaming_status", "network_type", "location", "is_fraud")
    )
    return f"""select rid, {event} as event_type, case when rid % 2 = 1 then user_id end as user_id,
        {std_time('event_time')} as event_time, os_type, {nulls} from ({raw_sql('edr')}) w"""


def paths(columns: str) -> str:
    return f"""with p as (select o_orderkey as rid, o_orderkey % 4 as folder, o_orderkey % 5 as name,
        o_orderkey % 7 as suffix from orders) select rid, {columns} from p"""


def _oracles() -> dict[str, str]:
    sql: dict[str, str] = {}
    for kind in KINDS:
        sql[f"alias_resolve_{kind}"] = standard(kind, not_foreign(kind), True, "rid")
        sql[f"alias_first_non_null_{kind}"] = standard(kind, not_foreign(kind), False, "rid")
        sql[f"clean_batch_{kind}"] = clean_table(kind)
        sql[f"clean_stream_{kind}"] = live_table(kind)
        sql[f"clean_stream_reference_{kind}"] = live_table(kind, "reference")
        sql[f"stream_dedup_{kind}"] = live_table(kind)
        sql[f"publish_{kind}"] = published(kind)
        sql[f"field_coverage_{kind}"] = coverage(kind)
    sql["edr_overview"] = f"""select event_type, count(*) as records, count(*) filter (is_fraud) as fraud_records
        from (select distinct * from ({batch_clean('edr', standard('edr', not_foreign('edr'), True))}) d) o
        group by event_type"""
    for policy in ("first_present", "first_non_null"):
        sql[f"alias_wide_{policy}"] = wide(policy)
    for field, kind in ENUM_KIND.items():
        for match, table in (("casefold", ENUM_WORDS), ("reference", REFERENCE_WORDS)):
            words, fallback = table[field]
            sql[f"enum_{match}_{field}"] = (
                f"select rid, {listed(f'lower({field})', words, fallback)} as {field} from ({raw_sql(kind)}) e"
            )
    words, fallback = ENUM_WORDS["event_type"]
    sql["enum_published_event_type"] = (
        "select rid, "
        + listed("trim(lower(event_type), ' ')", words.replace(", 'reboot'", ""), fallback)
        + f" as event_type from ({raw_sql('edr')}) e"
    )
    sql["unmapped_records"] = per_kind(
        lambda k: f"select '{k}' as record_type, rid from ({raw_sql(k)}) u where {FOREIGN[k]}"
    )
    # foreign records lack every name and are no case of this report
    sql["missing_field_report"] = f"""select field, count(*) as records from (
        select unnest(case when rid % 35 = 0 then ['location', 'os_type'] when rid % 5 = 0 then ['location']
        when rid % 7 = 0 then ['os_type'] else [] end) as field from ({not_foreign('edr')}) u) m group by field"""
    ipdr_flags = ", ".join(
        f"{loose_flag(q(c)) if c in FLAGS else q(c)} as {q(c)}" for c in COLUMNS["ipdr"]
    )
    sql["legacy_names"] = batch_clean("ipdr", f"select {ipdr_flags} from ({raw_sql('ipdr')}) f")
    sql["normalize_timestamp"] = per_kind(
        lambda k: f"select '{k}' as record_type, rid, {std_time(q(TIMES[k]))} as event_time from ({raw_sql(k)}) n"
    )
    sql["normalize_boolean"] = f"""select rid, {std_flag('roaming_status')} as roaming_status,
        {std_flag('is_fraud')} as is_fraud, rid <> 0 as from_number from ({raw_sql('edr')}) n"""
    sql["parse_boolean"] = f"""select rid, {loose_flag('roaming_status')} as roaming_status,
        {loose_flag('is_fraud')} as is_fraud, lower(roaming_status) in ('true', 't', '1', 'yes') as published
        from ({raw_sql('edr')}) n"""
    sql["parse_timestamp"] = f"select rid, {tidy_time('call_start')} as call_start from ({raw_sql('cdr')}) n"
    texts = ["event_id", "user_id", "device_model", "os_type", "network_type", "location", "event_type"]
    sql["string_clean_defaults"] = (
        "select rid, "
        + ", ".join(f"{scrubbed(c, DEFAULTS.get(c, 'unknown'))} as {c}" for c in texts)
        + f" from ({raw_sql('edr')}) n"
    )
    sql["blank_text_to_null"] = f"""select rid, nullif(imei, '') as from_csv,
        nullif(nullif(coalesce(imei, 'None'), 'None'), '') as from_xml from ({raw_sql('cdr')}) n"""
    sql["int_bool_defaults"] = (
        "select rid, "
        + ", ".join(f"{number(c)} as {c}" for c in ("port", "duration", "bytes_sent", "bytes_received"))
        + f", {digits('port')} as port_digits_only, {loose_flag('vpn_usage')} as vpn_usage from ({raw_sql('ipdr')}) n"
    )

    def repaired(kind: str) -> str:
        ids = [k for k in KEYS[kind] if k != TIMES[kind]]
        keys = ", ".join(
            f"coalesce(nullif({scrubbed(k, 'unknown')}, 'unknown'), 'default_{k.removesuffix('_id')}') as key_{i}"
            for i, k in enumerate(ids)
        )
        return f"""select '{kind}' as record_type, rid, {keys},
            coalesce({tidy_time(q(TIMES[kind]))}, '{RUN_TS}') as event_time from ({raw_sql(kind)}) n"""

    sql["key_repair"] = per_kind(repaired)
    sql["clean_batch_missing_columns"] = f"""select distinct
        coalesce(nullif({scrubbed('caller_id', 'unknown')}, 'unknown'), 'default_caller') as caller_id,
        'unknown' as callee_id, coalesce({tidy_time('call_start')}, '{RUN_TS}') as call_start,
        {number('call_duration')} as call_duration, 'voice_in' as call_type, 'unknown' as cell_id,
        'unknown' as location, {scrubbed('imei', 'unknown')} as imei, false as is_fraud
        from ({raw_sql('cdr')}) n"""
    edr_flags = ", ".join(f"{loose_flag(q(c)) if c in FLAGS else q(c)} as {q(c)}" for c in COLUMNS["edr"])
    sql["clean_batch_with_lineage"] = batch_clean(
        "edr",
        f"select {edr_flags} from ({raw_sql('edr')}) f",
        f", 'run-1' as batch_id, '{RUN_TS}' as processing_timestamp",
        fold=True,
    )

    def faults(kind: str) -> str:
        keys = [f"case when not broken then {q(c)} end" for c in KEYS[kind]]  # nothing of a cut-off body counts
        lacking = ", ".join(f"case when coalesce(trim({k}, ' '), '') = '' then '{c}' end" for c, k in zip(KEYS[kind], keys))
        shown = ", ".join(f"{k} as key_{i}" for i, k in enumerate(keys))
        return f"""select *, count(*) as records from (select '{kind}' as record_type, concat_ws(',', {lacking}) as faults,
            {shown} from ({live_values(kind, 'casefold')}) l) f where faults <> '' group by all"""

    sql["quarantine_live"] = per_kind(faults)
    sql["stream_quarantine"] = sql["quarantine_live"]
    sql["message_key"] = per_kind(
        lambda k: f"select '{k}' as topic, coalesce({'caller_id' if k == 'cdr' else 'user_id'}, '') as key, rid"
        f" from ({raw_sql(k)}) n"
    )
    names = ", ".join(q(c) for c in COLUMNS["ipdr"])
    sql["dedup_all_columns"] = f"select distinct {names} from ({raw_sql('ipdr', copies=True)}) n"
    ragged, flat = standard("edr", not_foreign("edr"), True), standard("edr", raw_sql("edr"))
    sql["union_merge_types"] = f"""select event_type, os_type, count(*) as records from (
        select event_type, os_type from ({ragged}) a union all select event_type, os_type from ({flat}) b
        union all select event_type, cast(null as varchar) from ({flat}) c) u group by event_type, os_type"""
    sql["key_quality"] = per_kind(
        lambda k: " union all ".join(
            f"select '{c}' as field, count(*) as records, count(*) filter ({q(c)} is null or {q(c)} = 'unknown')"
            f" as missing, '{k}' as record_type from ({raw_sql(k, copies=True)}) n"
            for c in KEYS[k]
        )
    )
    sql["fraud_count"] = f"""select count(*) as records, count(*) filter (is_fraud) as fraud_records
        from ({clean_table('cdr')}) n"""
    def missing(kind: str) -> str:  # a file has no empty text, only nulls
        return ", ".join(
            f"'{c}=' || count(*) filter (nullif({q(c)}, '') is null or {q(c)} = 'unknown')" for c in KEYS[kind]
        )

    sql["batch_metrics"] = per_kind(
        lambda k: f"""select '{k}' as "table", (select count(*) from ({raw_sql(k, copies=True)}) r)
            as records_before_cleaning, count(*) as records_after_cleaning,
            (select count(*) from ({raw_sql(k, copies=True)}) r) - count(*) as dropped_records,
            count(*) filter (is_fraud) as fraud_records, (select concat_ws(',', {missing(k)})
            from ({standard(k, raw_sql(k, copies=True))}) s) as missing_keys from ({clean_table(k)}) n"""
    )
    sql["route_record_type"] = paths(
        """case when name = 0 then 'ipdr' when name = 1 then 'edr' when name = 2 then 'cdr'
                when folder = 0 then 'ipdr' when folder = 1 then 'edr' end as record_type"""
    )
    sql["detect_format"] = paths(
        """case suffix when 0 then 'json' when 1 then 'csv' when 2 then 'xml' when 3 then 'gzip_json'
                when 4 then 'zip_csv' end as format"""
    )
    sql["subscriber_timeline"] = f"select subscriber, ts, source, is_fraud, payload from ({timeline_rows()}) n"
    sql["numbered_timeline"] = f"""select subscriber, row_number() over (partition by subscriber
        order by ts, source_rank, payload) as seq, ts, source, is_fraud, payload from ({timeline_rows()}) n"""
    sql["fraud_alerts"] = f"select * from ({clean_table('edr')}) n where is_fraud"
    sql["labelled_export"] = f"""select substr(call_start, 1, 7) as event_month, count(*) as records,
        count(*) filter (is_fraud) as fraud_records from ({clean_table('cdr')}) n group by 1"""
    sql["read_json"] = sql["read_json_gz"] = standard("edr", not_foreign("edr"), True)
    blank = f"select * replace (nullif(imei, '') as imei) from ({raw_sql('cdr')}) x"
    sql["read_json_lines"] = standard("cdr", raw_sql("cdr"))
    sql["read_csv"] = f"{standard('ipdr', raw_sql('ipdr'))} union all {standard('ipdr', raw_sql('ipdr'))}"
    sql["read_xml"] = standard("cdr", blank)
    sql["read_csv_zip"] = standard("edr", raw_sql("edr"))
    sql["crawl_files"] = per_kind(
        lambda k: f"""select '{k}' as record_type, {q(TIMES[k])} as event_time, is_fraud, 4 * count(*) as records
            from ({standard(k, raw_sql(k))}) n group by {q(TIMES[k])}, is_fraud"""
    )
    calls = f"select count(*) as n, count(*) filter (rid % 13 = 0) as cut from ({raw_sql('cdr')}) c"
    report = """select 'cdr' as record_type, 'json' as format, cast(null as varchar) as reason, n as records,
            0::bigint as damaged_lines from calls
        union all select 'cdr', 'csv', null, n, 0 from calls
        union all select null, 'csv', 'unknown record type', 0, 0
        union all select 'cdr', 'json', 'damaged', 0, 0
        union all select 'cdr', 'xml', 'damaged', 0, 0
        union all select 'cdr', 'json_lines', 'damaged', n - cut, cut from calls
        union all select 'cdr', null, 'unsupported format', 0, 0"""
    sql["crawl_report"] = f"with calls as ({calls}) {report}"
    sql["standardize_job"] = f"""with calls as ({calls}) {report}
        union all select 'cdr', 'merged', null, 3 * n - cut, 0 from calls"""
    sql["merged_batch"] = clean_table("cdr")
    edr_names = ", ".join(q(c) for c in COLUMNS["edr"])
    sql["headerless_merged"] = f"select {edr_names} from ({raw_sql('edr')}) n"
    sql["source_check"] = """select 'cdr' as topic, true as exists, count(*) as records, true as has_bytes from orders
        union all select 'ipdr', true, count(*), true from lineitem union all select 'edr', false, 0, false"""
    sql["stream_dedup_watermark"] = f"select * from ({live_table('edr')}) w where event_time >= '2024-01-20 00:00:00'"
    sql["stream_restart"] = live_table("cdr")
    sql["stream_fraud_alerts"] = f"select * from ({live_table('edr')}) n where is_fraud"
    sql["stream_throughput"] = per_kind(
        lambda k: f"select '{k}' as topic, count(*) as records from ({raw_sql(k, copies=True)}) n"
    )
    return sql


ORACLES: dict[str, str] = _oracles()
