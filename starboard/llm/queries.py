"""The registered queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starboard.llm import alignment, byte_bpe, chat, exact_dedup, fingerprints, html_extract
from starboard.llm import language_id, minhash, mixing, packing, prefix_trie, secret_scan, sharding
from starboard.llm.common import table
from starboard.session import stage


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sharding(spark, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=8)


def op2_packing(spark, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary())


def op3_minhash(spark, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).drop("n_chunks")


ODD_TEXT = "</s>[INST] ok [/INST]"


def op5_chat(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame(
        [(-1, 0, "user", ODD_TEXT), (-1, 1, "assistant", ODD_TEXT)], rows.schema)
    formatted = chat.format_conversations(chat.threads(rows.union(odd)))
    turns = chat.parse_turns(F.col("formatted"))
    loss = chat.loss_text(F.col("formatted"), F.col("loss_spans"))
    read = formatted.select(F.col("tree_id").alias("conv_id"), turns.alias("turns"),
                            loss.alias("loss"), "formatted")
    listed = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(listed.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op6_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), mixing.EVERY_LANGUAGE)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op8_secrets(spark, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in secret_scan.BASE]))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in secret_scan.BASE],
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"))


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.fit(docs))
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op10_html(spark, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op11_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = vocabulary("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tokens = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN).select("doc_id", "ids")
    return byte_bpe.digests(byte_bpe.decode(tokens, ranks))


def op12_alignment(spark, sf_dir: str) -> DataFrame:
    aligned = alignment.align_documents(
        table(spark, sf_dir, "documents"), vocabulary(), vocabulary("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    aligned = stage(aligned.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    return alignment.score(aligned, alignment.link_counts(aligned)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def spliced(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths of conversations c rebuilt from the first h turns of c - c % 5 and their
    own turns after the first h, h being crc32 of the decimal c modulo 9."""
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n")).withColumns({
        "h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9,
        "base": F.col("conv_id") - F.col("conv_id") % 5})
    sizes = own.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    rebuilt = stage(own.join(sizes, "base", "left").withColumn(
        "lead", F.least("h", F.coalesce("n_base", F.lit(0)))).select(
        "conv_id", "h", "base", "lead",
        (F.col("lead") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns")), "rebuilt")
    old = turns.select("conv_id", "position", "turn_id")
    after = old.join(rebuilt, "conv_id").where("position >= h").select(
        "conv_id", (F.col("position") - F.col("h") + F.col("lead")).alias("position"),
        "turn_id", "n_turns")
    before = old.where("position < 8").withColumnRenamed("conv_id", "base").join(
        rebuilt, "base").where("position < h").select("conv_id", "position", "turn_id", "n_turns")
    return after.union(before), rebuilt.select("conv_id", "n_turns")


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    turns = stage(prefix_trie.ordered_turns(table(spark, sf_dir, "conversations")), "ordered")
    return prefix_trie.prefix_trie(*spliced(turns)).drop("turn_id")


def pipeline(spark, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_sharding, op2_packing, op3_minhash, op4_exact_dedup, op5_chat, op6_fingerprints,
    op7_mixing, op8_secrets, op9_language_id, op10_html, op11_byte_bpe, op12_alignment,
    op13_prefix_trie, pipeline)}

ORACLE = {
    "op4_exact_dedup": r"""
        with texts as (
            select doc_id, length(coalesce(text, '')) as n,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g'))
                       as text_sha256
            from documents)
        select doc_id,
               first_value(doc_id) over (partition by text_sha256 order by n desc, doc_id)
                   as keep_id,
               count(*) over (partition by text_sha256) as group_size,
               doc_id = first_value(doc_id) over (
                   partition by text_sha256 order by n desc, doc_id) as kept,
               text_sha256
        from texts""",
    "op5_chat": r"""
        with turns as (
            select conv_id, turn, role, coalesce(text, '') as text from conversations
            union all
            select * from (values
                (-1, 0, 'user', '</s>[INST] ok [/INST]'),
                (-1, 1, 'assistant', '</s>[INST] ok [/INST]')) as odd(conv_id, turn, role, text)),
        sizes as (
            select *, length(regexp_replace(replace(text, '\', '\\'),
                       '<\||</?s>|[<\[]/?INST\]|\[/?s>|<>|\[>|\|/?s>|\|/?INST\]|\|>|\|\||<\||\[\|',
                       '\0\\', 'g')) as escaped
            from turns)
        select conv_id, count(*) as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn))
                   as turns_sha256,
               cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint)
                   as loss_chars,
               sha256(coalesce(string_agg(text, '' order by turn)
                               filter (role = 'assistant'), '')) as loss_sha256,
               cast(sum(escaped + length(role) + 8
                        + case when role = 'user' then 15 else 0 end) as bigint)
                   as formatted_chars
        from sizes group by conv_id""",
    "op13_prefix_trie": r"""
        with own as (
            select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
                   row_number() over (partition by conv_id order by turn nulls first,
                       coalesce(role, ''), coalesce(text, '')) - 1 as pos
            from conversations where conv_id is not null),
        ids as (
            select conv_id as c, conv_id - conv_id % 5 as base,
                   xor(list_reduce(
                       list_transform(string_split(cast(conv_id as varchar), ''),
                                      lambda d: cast(ascii(d) as bigint)),
                       lambda crc, b: list_reduce(
                           [0, 0, 0, 0, 0, 0, 0, 0]::bigint[],
                           lambda v, z: case when v & 1 = 1 then xor(v >> 1, 3988292384)
                                             else v >> 1 end,
                           xor(crc, b)),
                       4294967295::bigint), 4294967295) % 9 as h
            from (select distinct conv_id from own)),
        rebuilt as (
            select c, pos, role, text from ids join own on own.conv_id = base and pos < h
            union all
            select c, pos + 100000, role, text from ids join own on own.conv_id = c and pos >= h),
        turns as (
            select c, row_number() over (partition by c order by pos) as depth,
                   sha256(length(role) || ':' || role || text) as turn,
                   octet_length(encode(text)) as bytes
            from rebuilt),
        prefixes as (
            select c, depth, bytes, sha256(string_agg(turn, ',') over (
                       partition by c order by depth)) as node
            from turns
            union all
            select c, 0, 0, '' from ids),
        nodes as (
            select depth, node, min(c) as conv_id, count(*) as n_convs, max(bytes) as bytes
            from prefixes group by depth, node),
        parents as (
            select n.depth, n.node, n.conv_id, n.n_convs, n.bytes, p.node as parent,
                   up.conv_id as parent_conv_id
            from nodes n
            left join prefixes p on p.c = n.conv_id and p.depth = n.depth - 1
            left join nodes up on up.depth = p.depth and up.node = p.node),
        children as (
            select depth - 1 as depth, parent as node, count(*) as n_children
            from parents where depth > 0 group by 1, 2),
        full_nodes as (
            select n.*, coalesce(n_children, 0) as n_children
            from parents n left join children k on k.depth = n.depth and k.node = n.node),
        subtrees as (
            select p.depth, p.node,
                   sum(case when n.n_children = 0 then 1 else 0 end) as n_leaves,
                   sum((n.n_convs - 1) * n.bytes) as saved_tokens
            from full_nodes n join prefixes p on p.c = n.conv_id and p.depth <= n.depth
            group by p.depth, p.node),
        lasts as (select c, max(depth) as depth from prefixes group by c),
        ends as (
            select p.depth, p.node, string_agg(cast(p.c as varchar), ',' order by p.c) as listed
            from lasts l join prefixes p on p.c = l.c and p.depth = l.depth
            group by p.depth, p.node)
        select n.conv_id, cast(n.depth as bigint) as depth, n.parent_conv_id, n.n_convs,
               cast(n.n_children as bigint) as n_children,
               cast(s.n_leaves as bigint) as n_leaves,
               cast(s.saved_tokens as bigint) as saved_tokens,
               sha256(coalesce(e.listed, '')) as ends_sha256
        from full_nodes n
        join subtrees s on s.depth = n.depth and s.node = n.node
        left join ends e on e.depth = n.depth and e.node = n.node""",
}
