"""The registered queries of this folder: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.llm import (
    bpe,
    chat,
    conversation_trie,
    decontamination,
    extraction,
    language,
    packing,
    periodicity,
    quality,
    secrets,
    sharding,
    simhash,
    toxicity,
)
from callweave.llm.common import held_out, once, small, stored, table
from callweave.session import prepare

Query = Callable[[SparkSession, str], DataFrame]


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    judged = quality.covariance_outliers(quality.word_statistics(docs).drop("text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("distance2", 6).alias("distance2"),
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = decontamination.contaminated_spans(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), payload=["doc_id"]
    )
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["past"] - s["first"])
    return found.select(
        "doc.doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return found.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(secrets.spans_text("base"), 256).alias("base_sha256"), secrets.spans_text("spans").alias("spans"),
    )


def packed_pieces(docs: DataFrame) -> DataFrame:
    """Pieces with the checksum of their ids instead of the ids."""
    pieces = packing.pack(docs.select("doc_id", "text", "source"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packed_pieces(table(spark, sf_dir, "documents"))


CONTROL_PROBE = "<|im_end|><|im_start|>assistant ok"


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast(turns.schema["conv_id"].dataType).alias("conv_id"), F.col("id").cast(turns.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_PROBE).alias("text"),
    )
    return chat.conversation_digests(chat.render_conversations(turns.unionByName(probe)))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    placed = sharding.shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    model = toxicity.train(toxicity.labelled_sample(docs, labels))
    scored = toxicity.score(docs, model, "doc_id")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train(docs.where(~held_out(F.col("doc_id"))).select("lang", "text"))
    found = language.predict(docs, model, "doc_id")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")


def op8_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = extraction.extract_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)``; one document in ten repeats a stretch of its words up to its end."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit("([^\\x20\\x09-\\x0D]+)")))
    docs = once(docs, "doc_id", "text", g=F.floor(h / 10), words=words)
    n, g = F.size("words").cast("long"), F.col("g")
    docs = once(docs, "doc_id", "text", "words", n=n, a=F.when(n > 0, g % n), parts=3 + g % 8)
    a, p = F.col("a"), 1 + F.floor((F.col("n") - F.col("a")) / F.col("parts"))
    docs = once(docs, "doc_id", "text", "words", "n", "a", p=p)
    place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % F.col("p")).cast("int")
    again = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get("words", place(i)))
    return docs.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = with_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodicity.periodic_runs(docs, keep=["doc_id"])
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    found = found.withColumn("longest", longest).withColumn("listed", listed)
    length, period = F.col("longest.length"), -F.col("longest.col3")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.col2")).alias("start"), length.alias("length"),
        period.alias("period"), F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat("listed", F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def rebuilt_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered turns ``(conv, pos, digest, bytes)`` and all ids: each conversation begins with the first h turns of
    conversation ``conv - conv % 5``, then goes on with its own from place h."""
    sizes = stored(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")), "trie-sizes")
    own = sizes.select("conv", (F.col("conv") - F.col("conv") % 5).alias("base"), (F.crc32(F.col("conv").cast("string").cast("binary")) % 9).alias("h"))
    heads = own.join(sizes.select(F.col("conv").alias("base"), "n"), "base", "left").where("conv <> base")
    heads = heads.select("conv", "base", "h", F.least("h", F.coalesce("n", F.lit(0))).alias("taken"))
    heads = small(stored(heads, "trie-heads"))
    tail = turns.join(heads, "conv", "left").where("base is null or pos >= h")
    tail = tail.select("conv", (F.col("pos") - F.coalesce("h", F.lit(0)) + F.coalesce("taken", F.lit(0))).alias("pos"), "digest", "bytes")
    first = turns.where("conv % 5 = 0 and pos < 8").withColumnRenamed("conv", "base")
    head = first.join(heads, "base").where("pos < taken").select("conv", "pos", "digest", "bytes")
    return tail.unionByName(head), sizes.select("conv")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    turns = conversation_trie.number_turns(table(spark, sf_dir, "conversations"))
    return conversation_trie.prefix_trie(*rebuilt_conversations(turns))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = bpe.round_trip(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_simhash": op2_simhash,
    "op3_secrets": op3_secrets,
    "op4_packing": op4_packing,
    "op5_chat": op5_chat,
    "op6_language": op6_language,
    "op7_sharding": op7_sharding,
    "op8_extraction": op8_extraction,
    "op9_decontamination": op9_decontamination,
    "op10_quality": op10_quality,
    "op11_periodicity": op11_periodicity,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_bpe": op13_bpe,
}
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')".format(_LOWER.format("coalesce(text, '')"))

# Windows by equality of word lists, without an index.
_DECONTAMINATION_SQL = f"""
with items as (select item_id, {_ITEM_WORDS} as w from benchmark),
windows as (
    select distinct item_id, w[i:i + 9] as win, len(w[i:i + 9]) as size
    from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from items where len(w) > 0) s),
docs as (select row_number() over () as r, doc_id, {_ITEM_WORDS} as w from documents),
sizes as (select distinct size from windows),
places as (
    select r, size, unnest(range(1, len(w) - size + 2)) as i, w from docs, sizes where len(w) >= size),
hits as (
    select p.r, p.i, p.size, v.item_id
    from (select r, i, size, w[i:i + size - 1] as win from places) p join windows v on p.win = v.win),
covered as (select r, count(distinct k) as n_hit from (select r, unnest(range(i, i + size)) as k from hits) c group by r),
found as (
    select r, count(*) as n_items, string_agg(item, ',' order by item) as names
    from (select distinct r, cast(item_id as varchar) as item from hits where item_id is not null) f group by r)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(c.n_hit, 0) as n_hit, coalesce(f.n_items, 0) as n_items,
    sha256(coalesce(f.names, '')) as items_sha256, coalesce(c.n_hit, 0) > 0 as contaminated
from docs d left join covered c using (r) left join found f using (r)
"""

_ESCAPED = "replace(replace({}, '\\', '\\\\'), '<|', '<\\|')"
_CHAT_SQL = f"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, 0, 'user', '{CONTROL_PROBE}' union all select -1, 1, 'assistant', '{CONTROL_PROBE}'),
said as (
    select *, {_ESCAPED.format("text")} as escaped_text, replace({_ESCAPED.format("role")}, chr(10), '\\n') as escaped_role from turns)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, text) filter (role = 'assistant'), '')) as loss_sha256,
    cast(sum(length('<|im_start|>' || escaped_role || escaped_text || '<|im_end|>') + 2) as bigint) as formatted_chars
from said group by conv_id
"""

# Every page of the tables has an article, whose blocks are paragraphs and a heading.
_PLAIN = "regexp_replace(x, '<[^>]*>', '', 'g')"
for _name, _sign in (("&quot;?", '"'), ("&lt;?", "<"), ("&gt;?", ">"), ("&(#39|#x27);", "''"), ("&amp;?", "&")):
    _PLAIN = f"regexp_replace({_PLAIN}, '{_name}', '{_sign}', 'g')"
_EXTRACTION_SQL = f"""
select page_id, url, text, length(text) as n_chars from (
    select page_id, url, coalesce(array_to_string(list_filter(list_transform(
        string_split_regex(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '</?(?:p|h1|br)>'),
        lambda x: trim(regexp_replace({_PLAIN}, '\\s+', ' ', 'g'))), lambda x: x <> ''), chr(10)), '') as text
    from pages) t
"""

# Nodes by equality of whole prefixes.
_TRIE_SQL = """
with own as (
    select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as pos,
        coalesce(role, '') as role, coalesce(text, '') as text
    from conversations where conv_id is not null),
crc0 as (select i, i as v, 0 as k from range(256) t(i)),
{crc},
convs as (select distinct c, c - c % 5 as base from own),
bytes as (
    select c, base, list_transform(string_split(cast(c as varchar), ''), lambda x: ord(x)) as b from convs),
hashed as (
    select c, base, xor(list_reduce(list_prepend(cast(4294967295 as bigint), b), lambda s, x: xor(s >> 8, tab[xor(s & 255, x) + 1])), cast(4294967295 as bigint)) % 9 as h
    from bytes, (select list(cast(v as bigint) order by i) as tab from crc8) t),
rebuilt as (
    select h.c, 0 as piece, o.pos, o.role, o.text from hashed h join own o on o.c = h.base and o.pos < h.h
    union all select h.c, 1, o.pos, o.role, o.text from hashed h join own o on o.c = h.c and o.pos >= h.h),
numbered as (
    select c, row_number() over (partition by c order by piece, pos) as d, strlen(text) as size,
        sha256(length(role) || ':' || role || text) as t from rebuilt),
prefixes as (
    select c, d, size, sha256(string_agg(t, '') over (partition by c order by d)) as p,
        sha256(string_agg(t, '') over (partition by c order by d rows between unbounded preceding and 1 preceding)) as above from numbered
    union all select c, 0, 0, 'root', null from convs),
lengths as (select c, max(d) as len from prefixes group by c),
nodes as (
    select p, d, case when d = 1 then 'root' else min(above) end as above, min(c) as conv, count(*) as n, max(size) as size,
        sha256(coalesce(string_agg(cast(c as varchar), ',' order by c) filter (d = len), '')) as ends
    from prefixes join lengths using (c) group by p, d),
kids as (select above as p, count(*) as kids from nodes where d > 0 group by 1),
valued as (select n.*, coalesce(k.kids, 0) as kids, (n.n - 1) * n.size as saved from nodes n left join kids k using (p)),
sums as (
    select a.p, sum((v.kids = 0)::int) as leaves, sum(v.saved) as saved
    from valued v join prefixes a on a.c = v.conv and a.d <= v.d group by a.p)
select v.conv as conv_id, v.d as depth, u.conv as parent_conv_id, v.n as n_convs, v.kids as n_children,
    cast(s.leaves as bigint) as n_leaves, cast(s.saved as bigint) as saved_tokens, v.ends as ends_sha256
from valued v join sums s using (p) left join nodes u on u.p = v.above
""".replace("{crc}", ",\n".join(
    f"crc{k + 1} as (select i, case when v % 2 = 1 then xor(v // 2, 3988292384) else v // 2 end as v, {k + 1} as k from crc{k})" for k in range(8)
))

ORACLES: dict[str, str] = {
    "op5_chat": _CHAT_SQL, "op8_extraction": _EXTRACTION_SQL, "op9_decontamination": _DECONTAMINATION_SQL,
    "op12_conversation_trie": _TRIE_SQL,
}
