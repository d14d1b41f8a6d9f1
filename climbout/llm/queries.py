"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import remove_repeats

    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=100)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_store import read_tokens, write_tokens

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = read_tokens(write_tokens(docs, end_id=1))
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    pieces = pack(table(spark, sf_dir, "documents").select("doc_id", "text"), tokens=4096, end_id=2)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "loss_tokens")


def held_out() -> Column:
    from .quality_knn import fold

    return (fold(F.col("doc_id")) == 0).alias("held_out")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity_scores

    found = toxicity_scores(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", held_out(), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import matches

    found = matches(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), window=10)
    ids = F.sha2(F.encode(F.concat_ws(",", F.array_sort("items")), "UTF-8"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), ids.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import judge_urls

    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import similar_components

    return similar_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_score import pseudo_likelihood

    return pseudo_likelihood(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_knn import quality_scores

    found = quality_scores(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", held_out(), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_duplicates

    found = exact_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .byte_bpe import decode, encode

    back = decode(encode(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return back.select("doc_id", "n_tokens", F.sha2(F.col("decimals").cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def planted(doc_id: Column, text: Column) -> Column:
    """The text whose words from some word on repeat, for one doc_id in ten by its crc32; other texts as they are."""
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n, h = F.size(words).cast("long"), F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    cycle = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    tail = F.slice(F.flatten(F.array_repeat(cycle, F.ceil((n - a) / p).cast("int"))), F.lit(1), (n - a).cast("int"))
    repeated = F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " ")
    return F.when((h % 10 == 0) & (n > 0), repeated).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .periodic_runs import periodic_runs

    docs = table(spark, sf_dir, "documents").select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    found = periodic_runs(docs).select("doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), listed.alias("listed"), "collapsed")
    return found.select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.col("listed").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words",
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .merkle import digest, field, fold, proof_digest, prove

    docs = table(spark, sf_dir, "documents")
    head = [field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", _UPPER, _LOWER)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, digest(*head, field(lowered)))
    found = prove(docs.select("doc_id", "source", digest(*head, field(F.col("text"))).alias("leaf"), tampered.alias("other")))
    folded = found.select("doc_id", "leaf", "subroot", "root", proof_digest().alias("proof_sha256"), fold(F.coalesce("other", "leaf")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_token_store, op3_packing, op4_toxicity, op5_decontamination, op6_url_filter, op7_jaccard_join, op8_lm_score, op9_quality_knn, op10_exact_dedup, op11_byte_bpe, op12_periodic_runs, op13_merkle_manifest)}


def _url_sql() -> str:
    """op6 in SQL, from the same rules and terms."""
    from .url_filter import RULES, SOFT, SOFT_LIMIT, STRICT

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    fits = " ".join(f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') then '{h}{p}'" for _, h, p in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])))
    actions = " ".join(f"when '{h}{p}' then '{a}'" for a, h, p in RULES)
    weights = " + ".join(f"case when contains(low, '{t}') then {w} else 0 end" for t, w in SOFT.items())
    terms = " + ".join(f"case when contains(low, '{t}') then 1 else 0 end" for t in SOFT)
    return rf"""
        with u as (select page_id, coalesce(url, '') as url, translate(coalesce(url, ''), '{upper}', '{lower}') as low from pages),
        s as (select page_id, low, case when contains(url, '://') then regexp_replace(url, '(?s)^.*?://', '') else '' end as rest from u),
        p as (select page_id, low, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), '{upper}', '{lower}') as host, regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) as path from s),
        r as (select *, case {fits} end as rule from p)
        select page_id, host, path, rule, coalesce(case rule {actions} end,
               case when regexp_matches(low, '(^|[^a-z0-9])({"|".join(STRICT)})($|[^a-z0-9])') or ({terms} > 1 and {weights} >= {SOFT_LIMIT}) then 'block' else 'allow' end) as verdict
        from r"""


def _merkle_sql(levels: int = 8) -> str:
    """op13 in SQL: `levels` levels of each of the two trees, enough for 16 ** levels rows of a source; a root is carried up."""
    field = lambda c: f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"
    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    bit = "case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end"
    code = "cast(ascii(substr(cast(doc_id as varchar), i, 1)) as bigint)"
    crc = f"xor(4294967295, list_reduce([{code} for i in range(1, len(cast(doc_id as varchar)) + 1)], lambda c, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: {bit}, xor(c, b)), 4294967295::bigint))"
    run = "(partition by g, i // 16 order by i rows between"
    parts = [f"""leaves as (select doc_id, case when source is null then '0' else '1' || source end as g, sha256({head} || {field("text")}) as leaf,
                sha256({head} || {field(f"translate(text, '{_UPPER}', '{_LOWER}')")}) as other, coalesce({crc} % 5 = 0, false) as tampered from documents),
        s0 as (select doc_id, other, tampered, g, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by g) as n, leaf as h from leaves)"""]
    for t in "su":
        if t == "u":
            parts.append(f"u0 as (select g as source, 'all' as g, row_number() over (order by g) - 1 as i, count(*) over () as n, h from s{levels})")
        for k in range(levels):
            parts.append(f"""{t}{k}w as (select g, i, n, case when n = 1 then '' else coalesce(string_agg(h, '') over {run} 15 preceding and 1 preceding), '') end as l,
                case when n = 1 then '' else coalesce(string_agg(h, '') over {run} 1 following and 15 following), '') end as r from {t}{k})""")
            parts.append(f"""{t}{k + 1} as (select g, i // 16 as i, (any_value(n) + 15) // 16 as n, case when any_value(n) = 1 then any_value(h) else sha256(string_agg(h, '' order by i)) end as h
                from {t}{k} group by g, i // 16)""")
    parts.append("d0 as (select s0.doc_id, s0.g as sg, s0.i as si, u0.i as ui, s0.h as leaf, u0.h as subroot, case when tampered then other else s0.h end as folded, '' as proof from s0 join u0 on u0.source = s0.g)")
    for k in range(2 * levels):
        t, level, group, index = ("s", k, "d.sg", "d.si") if k < levels else ("u", k - levels, "'all'", "d.ui")
        parts.append(f"""d{k + 1} as (select d.* replace (case when x.n = 1 then d.folded else sha256(x.l || d.folded || x.r) end as folded, d.proof || x.l || x.r as proof)
                from d{k} d join {t}{level}w x on x.g = {group} and x.i = {index} // {16**level})""")
    return f"""
        with {", ".join(parts)}
        select doc_id, leaf, subroot, h as root, sha256(proof) as proof_sha256, folded as folded_root, folded = h as verified from d{2 * levels} join u{levels} on true"""


ORACLES = {
    "op5_decontamination": rf"""
        with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
        b as (select item_id, row_number() over () as item, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
        sized as (select *, least(10, len(w)) as size from b where len(w) > 0),
        windows as (select distinct item, item_id, size, array_to_string(w[i : i + size - 1], ' ') as win from (select *, unnest(range(1, len(w) - size + 2)) as i from sized)),
        placed as (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i from d, (select distinct size from sized)),
        found as (select p.doc_id, p.i, p.size, x.item, x.item_id from (select doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') as win from placed) p join windows x on p.win = x.win and p.size = x.size),
        hits as (select doc_id, count(distinct k) as n_hit from (select distinct doc_id, unnest(range(i, i + size)) as k from found) group by doc_id),
        items as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids from (select distinct doc_id, item, cast(item_id as varchar) as item_id from found where item_id is not null) group by doc_id)
        select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from d left join hits using (doc_id) left join items using (doc_id)""",
    "op6_url_filter": _url_sql(),
    "op7_jaccard_join": rf"""
        with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') as w from documents),
        s as (select distinct doc_id, array_to_string(w[i : i + 4], ' ') as g from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from d where len(w) > 0)),
        n as (select doc_id, count(*) as n from s group by doc_id),
        shared as (select x.doc_id as a, y.doc_id as b, count(*) as c from s x join s y on x.g = y.g and x.doc_id <> y.doc_id group by x.doc_id, y.doc_id),
        links as (select a, b from shared join n p on p.doc_id = a join n q on q.doc_id = b where 100 * c >= 80 * (p.n + q.n - c)),
        r(doc_id, reach) as (select doc_id, doc_id from d union select r.doc_id, links.b from r join links on links.a = r.reach)
        select d.doc_id, coalesce(n.n, 0) as n_shingles, m.component_id
        from d left join n using (doc_id) join (select doc_id, min(reach) as component_id from r group by doc_id) m using (doc_id)""",
    "op13_merkle_manifest": _merkle_sql(),
    "op10_exact_dedup": r"""
        with t as (
            select doc_id, length(coalesce(text, '')) as points,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
            from documents)
        select doc_id,
               first_value(doc_id) over (partition by text_sha256 order by points desc, doc_id) as keep_id,
               count(*) over (partition by text_sha256) as group_size,
               doc_id = first_value(doc_id) over (partition by text_sha256 order by points desc, doc_id) as kept,
               text_sha256
        from t""",
}
