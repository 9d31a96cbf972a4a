"""Registered label-ingestion queries and their SQL oracles.

Every reader is fed a projection of ``fixtures.label_sheet`` shaped like the
list it handles (column names, padding, malformed rows, repeats).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from hopweave.operators import labels as L
from hopweave.plans.registry import register
from hopweave.sources import fixtures as fx

FX = ["fx_label_sheet"]
ADDR = "'^0x[a-fA-F0-9]{40}$'"


def st(x):
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def nm(x):
    return f"lower({st(x)})"


def ok(x):
    return f"regexp_matches({x}, {ADDR})"


def first(inner):
    return (f"select address, cast(is_scam as bigint) as is_scam, description from ({inner}) "
            f"qualify row_number() over (partition by address order by row_no) = 1")


def out(inner):
    return f"select address, cast(is_scam as bigint) as is_scam, description from ({inner})"


def join_ne(parts, sep="; "):
    arr = ", ".join(f"coalesce({st(p)}, '')" for p in parts)
    return f"array_to_string(list_filter([{arr}], lambda x: x <> ''), '{sep}')"


def sheet(spark, sf_dir):
    return fx.label_sheet(spark, sf_dir)


S = "fx_label_sheet"


@register("lbl_node_attr", sql=out(f"select address, case when flag = '1' then 1 else 0 end as is_scam, "
                                   f"case when flag = '1' then 'phishing' else '' end as description from {S}"), fixtures=FX)
def q_node_attr(spark, sf_dir):
    """Graph node table → labels."""
    return L.lbl_node_attr(sheet(spark, sf_dir).select(F.col("address").alias("node"), (F.col("flag") == "1").alias("isp")))


@register("lbl_binary_csv", sql=first(
    f"select {nm('address')} as address, case when {st('flag')} = '1' then 1 else 0 end as is_scam, "
    f"case when {st('flag')} = '1' then 'ponzi' end as description, row_no from {S} where {ok(nm('address'))}"),
    fixtures=FX)
def q_binary(spark, sf_dir):
    """(address, label) list, first row per address."""
    return L.lbl_binary_csv(sheet(spark, sf_dir).select("address", F.col("flag").alias("label"), "row_no"))


def _flags_df(spark, sf_dir):
    s = sheet(spark, sf_dir)
    return s.select(F.col("address").alias(" address "), F.col("flag").alias("Mint"),
                    F.when(F.col("segment") == "HOUSEHOLD", "2").when(F.col("segment") == "MACHINERY", "abc")
                    .otherwise("").alias("Leak "))


def _tp_df(spark, sf_dir):
    s = sheet(spark, sf_dir)
    return s.select(F.col("address").alias(" Address"),
                    F.when(F.col("flag") == "1", " Yes").when(F.col("segment") == "MACHINERY", "YES ")
                    .otherwise("no").alias("TP?"))


_FLAG_SQL = (f"select {nm('address')} as address, case when t > 0 then 1 else 0 end as is_scam, "
             f"case when t > 0 then 'rugpull' end as description from (select address, "
             f"cast(trunc(coalesce(try_cast(flag as double), 0)) as bigint) + cast(trunc(coalesce(try_cast("
             f"case when segment = 'HOUSEHOLD' then '2' when segment = 'MACHINERY' then 'abc' else '' end as double), 0)) "
             f"as bigint) as t from {S}) where {ok(nm('address'))}")
_TP = "case when flag = '1' then ' Yes' when segment = 'MACHINERY' then 'YES ' else 'no' end"
_TP_SQL = (f"select {nm('address')} as address, 1 as is_scam, 'rugpull' as description from {S} "
           f"where {ok(nm('address'))} and lower({st(_TP)}) = 'yes'")


@register("lbl_any_flag", sql=out(_FLAG_SQL), fixtures=FX)
def q_any_flag(spark, sf_dir):
    """Numeric flag columns (one missing) → rugpull when their total is positive."""
    return L.lbl_any_flag(_flags_df(spark, sf_dir))


@register("lbl_tp_yes", sql=out(_TP_SQL), fixtures=FX)
def q_tp_yes(spark, sf_dir):
    """yes/no sheet with a case-insensitive TP column."""
    return L.lbl_tp_yes(_tp_df(spark, sf_dir))


@register("lbl_union_max", sql=out(
    f"select address, max(is_scam) as is_scam, case when bool_or(description = 'rugpull') then 'rugpull' end as description "
    f"from ({_FLAG_SQL} union all {_TP_SQL}) group by address"), fixtures=FX)
def q_union_max(spark, sf_dir):
    """Union of flag and yes/no lists, max label per address."""
    return L.lbl_union_max(L.lbl_any_flag(_flags_df(spark, sf_dir)), L.lbl_tp_yes(_tp_df(spark, sf_dir)))


def _wide(spark, sf_dir):
    s = sheet(spark, sf_dir)
    return s.select(F.when(F.col("flag") == "1", F.col("address")).otherwise(F.col("tag")).alias("phish_cat"),
                    F.col("row_no").cast("string").alias("tx_total"), F.col("segment").alias("type"),
                    F.col("address").alias("stray"),
                    F.when(F.col("segment") == "BUILDING", F.col("address")).otherwise("").alias("drainer"),
                    F.lit("1").alias("txcount"), F.lit("x").alias("types"))


def _concat_sql(rows):
    return (f"select address, 1 as is_scam, coalesce(array_to_string(list_sort(list(description) filter "
            f"(where {st('description')} <> '')), ';'), '') as description from (select distinct address, "
            f"coalesce(description, '') as description from ({rows})) group by address")


_TRIP_ROWS = (f"select lower({st('v')}) as address, d as description from ("
              f"select case when flag = '1' then address else tag end as v, 'phish_cat' as d from {S} "
              f"union all select address, '' from {S} "
              f"union all select case when segment = 'BUILDING' then address else '' end, 'drainer' from {S}) "
              f"where {ok(st('v'))}")


@register("lbl_column_triplets", sql=out(_concat_sql(_TRIP_ROWS)), fixtures=FX)
def q_triplets(spark, sf_dir):
    """Wide sheet with (category, tx…, type…) column triplets."""
    return L.lbl_column_triplets(_wide(spark, sf_dir))


@register("lbl_category_concat", sql=out(_concat_sql(
    f"select {nm('address')} as address, tag as description from {S} where {ok(nm('address'))}")), fixtures=FX)
def q_cat_concat(spark, sf_dir):
    """Sorted distinct categories per address joined with ';'."""
    s = sheet(spark, sf_dir)
    return L.lbl_category_concat(s.where(L.valid(L.norm("address")))
                                 .select(L.norm("address").alias("address"), F.col("tag").alias("description")))


_LOG_LINE = ("case when segment = 'MACHINERY' then concat('# ', address) when segment = 'HOUSEHOLD' then "
             "concat('   ', address, '  note ', name) when segment = 'FURNITURE' then '' else concat(address, ' ', tag) end")


@register("lbl_text_log", sql=out(
    f"select distinct lower(tok) as address, 1 as is_scam, 'phishing' as description from (select {st('v')} as s, "
    f"string_split_regex({st('v')}, '\\s+')[1] as tok from (select {_LOG_LINE} as v from {S})) "
    f"where s <> '' and not starts_with(s, '#') and not starts_with(s, '//') and {ok('tok')}"), fixtures=FX)
def q_text_log(spark, sf_dir):
    """Address log lines with comments and notes."""
    s = sheet(spark, sf_dir)
    seg = F.col("segment")
    line = (F.when(seg == "MACHINERY", F.concat(F.lit("# "), F.col("address")))
            .when(seg == "HOUSEHOLD", F.concat(F.lit("   "), F.col("address"), F.lit("  note "), F.col("name")))
            .when(seg == "FURNITURE", F.lit("")).otherwise(F.concat(F.col("address"), F.lit(" "), F.col("tag"))))
    return L.lbl_text_log(s.select(line.alias("value")))


@register("lbl_verified_csv", sql=out(
    f"select lower(address) as address, 0 as is_scam, concat(coalesce(case when tag = '' then null else tag end, 'nan'), "
    f"';verified') as description from {S}"), fixtures=FX)
def q_verified(spark, sf_dir):
    """Verified-contract export: clean, ``name;verified``."""
    s = sheet(spark, sf_dir)
    return L.lbl_verified_csv(s.select(F.col("address").alias("ContractAddress"),
                                       F.when(F.col("tag") == "", None).otherwise(F.col("tag")).alias("ContractName")))


def _jl(spark, sf_dir):
    s = sheet(spark, sf_dir)
    return s.select("address", F.when(F.col("tag") == "", None).otherwise(F.col("name")).alias("comment"))


@register("lbl_json_list", sql=out(
    f"select lower(address) as address, 1 as is_scam, case when tag = '' then null else name end as description from {S}"),
    fixtures=FX)
def q_json_dark(spark, sf_dir):
    """Dark list of {address, comment}."""
    return L.lbl_json_list(_jl(spark, sf_dir), dark=True)


@register("lbl_json_list_light", sql=out(
    f"select lower(address) as address, 0 as is_scam, (case when tag = '' then null else name end) || '; verified' "
    f"as description from {S}"), fixtures=FX)
def q_json_light(spark, sf_dir):
    """Light list of {address, comment}: clean, ``comment; verified``."""
    return L.lbl_json_list(_jl(spark, sf_dir), dark=False)


@register("lbl_nested_array", sql=out(
    f"select distinct lower({st('a')}) as address, 1 as is_scam, case when {st('coalesce(category, ' + chr(39) * 2 + ')')} "
    f"<> '' then {st('category')} end as description from (select unnest(addresses) as a, category from ("
    f"select [address, upper(address), concat('bad', cast(row_no as varchar))] as addresses, "
    f"case when segment = 'MACHINERY' then '  ' else segment end as category from {S}) where len(addresses) > 0) "
    f"where {ok(st('a'))}"), fixtures=FX)
def q_nested_array(spark, sf_dir):
    """Records with an address array and a category."""
    s = sheet(spark, sf_dir)
    return L.lbl_nested_array(s.select(
        F.array("address", F.upper("address"), F.concat(F.lit("bad"), F.col("row_no").cast("string"))).alias("addresses"),
        F.when(F.col("segment") == "MACHINERY", "  ").otherwise(F.col("segment")).alias("category")))


def _nm(spark, sf_dir):
    s = sheet(spark, sf_dir)
    return s.select(F.struct(F.array("address", "name").alias("ETH")).alias("addresses"),
                    F.when(F.col("flag") == "1", F.col("segment")).otherwise("").alias("category"), "name")


@register("lbl_nested_map", sql=out(
    f"select a as address, 1 as is_scam, case when c <> '' then c end as description from (select unnest([address, name]) "
    f"as a, case when flag = '1' then segment else '' end as c from {S})"), fixtures=FX)
def q_nested_map(spark, sf_dir):
    """Records with ``addresses.ETH[]``: scam list."""
    return L.lbl_nested_map(_nm(spark, sf_dir))


@register("lbl_nested_map_white", sql=out(
    f"select a as address, 0 as is_scam, concat(n, ';verified') as description from (select unnest([address, name]) "
    f"as a, name as n from {S})"), fixtures=FX)
def q_nested_map_white(spark, sf_dir):
    """Records with ``addresses.ETH[]``: white list (``name;verified``)."""
    return L.lbl_nested_map(_nm(spark, sf_dir), white=True)


@register("lbl_json_field_array", sql=out(
    f"select a as address, 1 as is_scam, 'phishing' as description from (select unnest([address, name]) as a from {S}) "
    f"where {ok('a')}"), fixtures=FX)
def q_field_array(spark, sf_dir):
    """Object field holding an address array; case kept."""
    return L.lbl_json_field_array(sheet(spark, sf_dir).select(F.array("address", "name").alias("address")))


@register("lbl_tag_concat", sql=out(
    f"select {st('address')} as address, 1 as is_scam, case when j <> '' then j else 'phishing' end as description from ("
    f"select address, {join_ne(['tag', 'case when flag = ' + chr(39) + '1' + chr(39) + ' then segment end'])} as j "
    f"from {S})"), fixtures=FX)
def q_tag_concat(spark, sf_dir):
    """Tag and label joined, default 'phishing'."""
    s = sheet(spark, sf_dir)
    return L.lbl_tag_concat(s.select("address", F.col("tag").alias("etherscan_tag"),
                                     F.when(F.col("flag") == "1", F.col("segment")).alias("etherscan_labels")))


def _tcd_sql():
    p1, p2, p3 = st("tag"), st("segment"), st("tag")
    p4 = st("case when flag = '1' then name else '' end")
    arr = (f"[{p1}, case when {p2} <> {p1} then {p2} else '' end, case when {p3} not in ({p1}, {p2}) then {p3} else '' end, "
           f"case when {p4} not in ({p1}, {p2}, {p3}) then {p4} else '' end]")
    j = f"array_to_string(list_filter({arr}, lambda x: x <> ''), '; ')"
    return first(f"select {nm('address')} as address, 1 as is_scam, case when {j} <> '' then {j} else 'phishing' end "
                 f"as description, row_no from {S} where {ok(nm('address'))}")


@register("lbl_tag_concat_distinct", sql=_tcd_sql(), fixtures=FX)
def q_tag_concat_distinct(spark, sf_dir):
    """Four text fields joined without repeats; first row per address."""
    s = sheet(spark, sf_dir)
    return L.lbl_tag_concat_distinct(s.select(
        F.col("address").alias("contract_address"), F.col("tag").alias("contract_tag"),
        F.col("segment").alias("contract_creator_tag"), F.col("tag").alias("contract_creator_etherscan_label"),
        F.when(F.col("flag") == "1", F.col("name")).otherwise("").alias("notes"), "row_no"))


@register("lbl_default_value", sql=first(
    f"select {nm('address')} as address, 1 as is_scam, case when {st('tag')} = '' then 'phishing' else {st('tag')} end "
    f"as description, row_no from {S} where {ok(nm('address'))}"), fixtures=FX)
def q_default(spark, sf_dir):
    """Empty wallet tag → 'phishing'."""
    s = sheet(spark, sf_dir)
    return L.lbl_default_value(s.select(F.col("address").alias("banned_address"), F.col("tag").alias("wallet_tag"),
                                        "row_no"))


_LABEL = "case when flag = '1' then ' Dodgy' when segment = 'BUILDING' then 'unknown' else 'legit' end"


@register("lbl_status_map", sql=first(
    f"select {nm('address')} as address, case when lower({st(_LABEL)}) = 'legit' then 0 else 1 end as is_scam, "
    f"{join_ne(['name', 'tag', 'segment'])} as description, row_no from {S} where {ok(nm('address'))}"), fixtures=FX)
def q_status(spark, sf_dir):
    """legit/dodgy/other status sheet; Name and columns from the 7th on."""
    s = sheet(spark, sf_dir)
    lab = (F.when(F.col("flag") == "1", " Dodgy").when(F.col("segment") == "BUILDING", "unknown").otherwise("legit"))
    return L.lbl_status_map(s.select(F.col("address").alias("Address"), F.col("name").alias("Name"), lab.alias("Label"),
                                     F.col("flag").alias("c3"), F.col("flag").alias("c4"), F.col("flag").alias("c5"),
                                     F.col("tag").alias("TagA"), F.col("segment").alias("TagB"), "row_no"))


@register("lbl_flag_only", sql=first(
    f"select {nm('address')} as address, case when {st('flag')} = '1' then 1 else 0 end as is_scam, "
    f"cast(null as varchar) as description, row_no from {S} where {ok(nm('address'))}"), fixtures=FX)
def q_flag_only(spark, sf_dir):
    """(Address, FLAG) list."""
    s = sheet(spark, sf_dir)
    return L.lbl_flag_only(s.select(F.col("address").alias("Address"), F.col("flag").alias("FLAG"), "row_no"))


@register("lbl_all_scam", sql=first(
    f"select {nm('address')} as address, 1 as is_scam, case when {st('tag')} = '' then null else {st('tag')} end "
    f"as description, row_no from {S} where {ok(nm('address'))}"), fixtures=FX)
def q_all_scam(spark, sf_dir):
    """Report list: every row scam, name tag or NULL."""
    s = sheet(spark, sf_dir)
    return L.lbl_all_scam(s.select("address", F.col("tag").alias("name_tag"), "row_no"))


@register("lbl_tags_by_prefix", sql=first(
    f"select {nm('address')} as address, case when flag = '1' then 1 else 0 end as is_scam, "
    f"case when {join_ne(['name', 'tag', 'segment'])} <> '' then {join_ne(['name', 'tag', 'segment'])} end as description, "
    f"row_no from {S} where {ok(nm('address'))}"), fixtures=FX)
def q_tags_prefix(spark, sf_dir):
    """Name plus Tags… columns; dodgy → 1."""
    s = sheet(spark, sf_dir)
    return L.lbl_tags_by_prefix(s.select(F.col("address").alias("Address"),
                                         F.when(F.col("flag") == "1", "Dodgy").otherwise("Legit").alias("Label"),
                                         F.col("name").alias("Name"), F.col("tag").alias("Tags"),
                                         F.col("segment").alias("Tags2"), "row_no"))


@register("lbl_exchanges", sql=out(
    f"select {nm('address')} as address, 0 as is_scam, case when {st('tag')} <> '' then concat({st('tag')}, '; exchanges') "
    f"else 'exchanges' end as description from {S} where {ok(nm('address'))}"), fixtures=FX)
def q_exchanges(spark, sf_dir):
    """Exchange list: clean, duplicates kept."""
    s = sheet(spark, sf_dir)
    return L.lbl_exchanges(s.select(F.col("address").alias("Address"), F.col("tag").alias("Name Tag")))


@register("lbl_reported", sql=out(
    f"select {nm('address')} as address, 1 as is_scam, case when {st('tag')} <> '' then concat({st('tag')}, "
    f"'; etherscan reported') end as description from {S}"), fixtures=FX)
def q_reported(spark, sf_dir):
    """Reported accounts: no address check, duplicates kept."""
    s = sheet(spark, sf_dir)
    return L.lbl_reported(s.select("address", F.col("tag").alias("name_tag")))


def _dumps(spark, sf_dir):
    s = sheet(spark, sf_dir)
    labels = F.filter(F.array("tag", "segment", F.when(F.col("flag") == "1", "Phish / Hack").otherwise("")),
                      lambda x: x != "")
    acc = s.select("address", "name", labels.alias("labels"), "row_no")
    tok = s.where(F.col("segment").isin("MACHINERY", "F")).select(
        "address", F.concat(F.lit("Token "), F.col("name")).alias("name"),
        F.array(F.lit("Token"), F.col("tag")).alias("labels"), "row_no")
    return acc, tok


_KW = " or ".join(f"contains(lower(coalesce({{x}}, '')), '{k}')" for k in L.DODGY_KEYWORDS)


def _kw_ctes():
    lab = ("list_filter([tag, segment, case when flag = '1' then 'Phish / Hack' else '' end], lambda x: x <> '')")
    name_hit = _KW.format(x="name")
    lab_hit = "len(list_filter(labels, lambda l: " + _KW.format(x="l") + ")) > 0"
    return (f"WITH u AS (select lower(address) as address, name, {lab} as labels, row_no, false as is_token from {S} "
            f"union all select lower(address), concat('Token ', name), ['Token', tag], row_no, true from {S} "
            f"where segment in ('MACHINERY', 'F')), "
            f"one AS (select * exclude (row_no), (select min(case when x.is_token then x.row_no + 1000000000000000 else x.row_no end) "
            f"from u x where x.address = w.address) as row_no from (select * from u qualify row_number() over "
            f"(partition by address order by is_token desc, row_no desc) = 1) w), "
            f"kc AS (select address as \"Address\", coalesce(name, '') as \"Name\", "
            f"case when is_token then 'Smart Contract' else 'Wallet' end as \"Account Type\", "
            f"case when is_token then 'Token' else '' end as \"Contract Type\", coalesce(labels[1], '') as \"Entity\", "
            f"case when ({name_hit}) or ({lab_hit}) then 'Dodgy' else 'Legit' end as \"Label\", "
            + ", ".join(f"coalesce(labels[{i + 1}], '') as \"Tag{i + 1}\"" for i in range(5)) + ", row_no from one) ")


def _kw_sql():
    return _kw_ctes() + "select * from kc"


def _kwf_sql():
    j = join_ne(['"Name"'] + [f'"Tag{i}"' for i in range(1, 6)])
    return _kw_ctes() + (f"select {nm(chr(34) + 'Address' + chr(34))} as address, cast(case when lower({st(chr(34) + 'Label' + chr(34))}) "
                         f"= 'dodgy' then 1 else 0 end as bigint) as is_scam, case when {j} <> '' then {j} end as description "
                         f"from kc where {ok(nm(chr(34) + 'Address' + chr(34)))} qualify row_number() over (partition by "
                         f"{nm(chr(34) + 'Address' + chr(34))} order by row_no) = 1")


@register("lbl_keyword_class", sql=_kw_sql(), fixtures=FX)
def q_kw_class(spark, sf_dir):
    """Label dumps classified by keywords; token entries override accounts."""
    acc, tok = _dumps(spark, sf_dir)
    return L.lbl_keyword_class(acc, tok)


@register("lbl_keyword_flags", sql=_kwf_sql(), fixtures=FX)
def q_kw_flags(spark, sf_dir):
    """Classified dump → (address, is_scam, description)."""
    acc, tok = _dumps(spark, sf_dir)
    return L.lbl_keyword_flags(L.lbl_keyword_class(acc, tok))


def _merge_sql():
    def src(name, i):
        return (f"select cast(address as varchar) as address, cast(is_scam as varchar) as is_scam, "
                f"cast(description as varchar) as description, {i} as src_order, row_no from {name}")
    d = st("description")
    return (f"WITH u AS ({src('fx_label_src_a', 0)} union all {src('fx_label_src_b', 1)}), "
            f"c AS (select {nm('address')} as address, coalesce(cast(trunc(try_cast({st('is_scam')} as double)) as int), 0) "
            f"as is_scam, case when {d} is null or lower({d}) in ('null', 'none', 'nan') or {d} = '' then null else {d} end "
            f"as description, src_order, row_no from u where {ok(nm('address'))}) "
            f"select address, cast(is_scam as bigint) as is_scam, description from c qualify row_number() over ("
            f"partition by address order by is_scam desc, (description is not null and length(description) > 0) desc, "
            f"src_order, row_no) = 1")


@register("lbl_merge_priority", sql=_merge_sql(), fixtures=["fx_label_src_a", "fx_label_src_b"])
def q_merge(spark, sf_dir):
    """Priority merge of label lists: scam first, described first, earlier source first."""
    return L.lbl_merge_priority([fx.label_src_a(spark, sf_dir), fx.label_src_b(spark, sf_dir)])


@register("lbl_class_counts", sql=(
    "select case when is_scam = 0 then 'clean' when is_scam = 1 then 'scam' else cast(is_scam as varchar) end as type, "
    "count(*) as count from (" + _merge_sql() + ") group by is_scam"), fixtures=["fx_label_src_a", "fx_label_src_b"])
def q_counts(spark, sf_dir):
    """Clean / scam counts of the merged list."""
    return L.lbl_class_counts(L.lbl_merge_priority([fx.label_src_a(spark, sf_dir), fx.label_src_b(spark, sf_dir)]))


def _write_sources(spark, sf_dir, root):
    """Two label lists and one without a description column, as CSV part files under
    ``<root>/<source>/processed/`` in row order."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    srcs = {"a": fx.label_src_a(spark, sf_dir), "b": fx.label_src_b(spark, sf_dir),
            "c": fx.label_src_a(spark, sf_dir).drop("description")}
    for name, df in srcs.items():
        (df.drop("src_order").repartitionByRange(n, "row_no").sortWithinPartitions("row_no")
         .write.mode("overwrite").option("header", True).csv(f"{root}/{name}/processed"))


@register("lbl_skip_bad_files", sql=_merge_sql(), fixtures=["fx_label_src_a", "fx_label_src_b"])
def q_skip_bad(spark, sf_dir):
    """Label CSV folders merged in sorted path order; a file without the required columns is skipped."""
    from hopweave.session import stage_path
    from hopweave.sources import label_files as LF
    root = stage_path(spark, "label_lists")
    _write_sources(spark, sf_dir, root)
    return L.lbl_merge_priority(LF.read_label_dir(spark, LF.list_label_csvs(root, spark), order_col="row_no"))
