"""The operators applied to whole tables, with the SQL of their results where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.llm import bpe, debruijn, decontaminate, jaccard, language, licenses, merkle, periodic, secrets, tokens, urls, vectors, warc
from tablekit.storage import work_dir

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op1_warc",
    """
    with p as (select page_id, encode(coalesce(html, '')) as payload from pages),
    d as (select page_id, octet_length(payload)::bigint as payload_bytes, sha1(payload) as payload_digest from p),
    g as (select payload_digest, max(page_id) as original from d where payload_bytes >= 1000 group by 1)
    select page_id, payload_bytes, payload_digest,
           case when original is not null and original <> page_id then 'revisit' else 'response' end as record_type,
           case when original <> page_id then original end as refers_to
    from d left join g using (payload_digest)
    """,
)
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "warc")
    warc.write(warc.chunk_rows(warc.plan_records(table(spark, sf_dir, "pages"))), path)
    return warc.read_records(spark, path).select(
        F.col("record_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


@query("op7_secret_scan")
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(table(spark, sf_dir, "documents"))

    def of(*kinds: str):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    base = ("assign", "access", "hex")
    return found.select(
        "doc_id",
        *(F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in base),
        F.sha2(secrets.listed(of(*base)), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


ORACLE_8 = f"""
    with d as (select doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') as w from documents),
    b as (select item_id::varchar as item, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') as w from benchmark),
    runs as (
        select distinct item, n, w[i:i + n - 1] as run
        from (select item, w, least(len(w), 10) as n, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i from b where len(w) > 0)
    ),
    sizes as (select distinct n from runs),
    places as (
        select doc_id, i, n, w[i:i + n - 1] as run
        from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes where len(w) >= n)
    ),
    found as (select doc_id, i, n, item from places join runs using (n, run)),
    hits as (select doc_id, count(distinct pos) as n_hit from (select doc_id, unnest(range(i, i + n)) as pos from found) group by 1),
    named as (select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from found group by 1)
    select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
           sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
    from d left join hits using (doc_id) left join named using (doc_id)
    """


@query("op8_decontaminate", ORACLE_8)
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = decontaminate.hit_words()
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@query("op9_byte_bpe")
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), VOCABULARY)


ORACLE_2 = f"""
    with recursive d as (
        select doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') as w from documents
    ),
    s as (
        select distinct doc_id, w[i:i + 2] as s
        from (select doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) as i from d where len(w) > 0)
    ),
    n as (select doc_id, count(*) as n from s group by 1),
    prints as (select doc_id, n, min(doc_id) over (partition by p) as first from (select doc_id, count(*) as n, md5(string_agg(s::varchar, '|' order by s)) as p from s group by 1)),
    r as (select s.* from s join prints using (doc_id) where first = doc_id),
    common as (select s from r group by 1 having count(*) > 1),
    rc as (select r.* from r join common using (s)),
    pairs as (
        select a.doc_id as a, b.doc_id as b, count(*) as agree
        from rc a join rc b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2
    ),
    links as (
        select a, b from pairs join n na on na.doc_id = a join n nb on nb.doc_id = b where agree * 100 >= (na.n + nb.n - agree) * 90
    ),
    edges as (select a, b from links union select b, a from links),
    reach as (select doc_id as a, doc_id as b from prints where first = doc_id union select reach.a, edges.b from reach join edges on reach.b = edges.a),
    c as (select a, min(b) as component from reach group by 1)
    select d.doc_id, coalesce(prints.n, 0)::bigint as n_shingles, coalesce(component, d.doc_id) as component_id
    from d left join prints using (doc_id) left join c on c.a = prints.first
    """


@query("op2_jaccard_join", ORACLE_2)
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"), n=3, num=90, den=100)


@query(
    "op4_embedding_near_dup",
    """
    with recursive v as (select vec_id, embedding::double[] as e from embeddings),
    n as (select vec_id, e, sqrt(list_dot_product(e, e)) as norm from v),
    links as (
        select a.vec_id as a, b.vec_id as b from n a join n b on a.vec_id <> b.vec_id
        where a.norm > 0 and b.norm > 0 and list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.9
    ),
    counts as (select a, count(*) as n_links from links group by 1),
    reach as (select vec_id as a, vec_id as b from v union select reach.a, links.b from reach join links on reach.b = links.a),
    c as (select a, min(b) as component_id from reach group by 1)
    select vec_id, coalesce(n_links, 0)::bigint as n_links, component_id, vec_id = component_id as kept
    from v join c on c.a = vec_id left join counts on counts.a = vec_id
    """,
)
def op4_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language.remainder("doc_id") == 1
    prototypes = language.learn(docs.where(~held_out))
    return language.predict(docs, prototypes).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.counts(table(spark, sf_dir, "documents"), tokens.read_pieces(PIECES))


RULES = [
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
]


@query(
    "op10_url_filter",
    """
    with u as (select page_id, case when strpos(coalesce(url, ''), '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
    p as (
        select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u
    ),
    r(rule_host, rule_path, rule_verdict) as (
        values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
    ),
    f as (
        select page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule, arg_max(rule_verdict, length(rule_host || rule_path)) as rule_verdict
        from p join r on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path) group by 1
    ),
    j as (select p.*, rule, rule_verdict from p left join f using (page_id)),
    b as (select host from j group by 1 having count(*) filter (rule_verdict = 'block') > count(*) filter (rule_verdict = 'allow'))
    select page_id, j.host, path, rule, coalesce(rule_verdict, case when b.host is null then 'allow' else 'block' end) as verdict
    from j left join b on j.host = b.host
    """,
)
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), RULES)


def _oracle_3() -> str:
    rows = ", ".join(f"('{name}', [{', '.join(repr(g) for g in licenses.bigrams(text))}], {len(licenses.pairs(text))})" for name, text in licenses.TEMPLATES.items())
    return f"""
    with t(license, grams, n) as (values {rows}),
    l as (select doc_id, string_split(lower(coalesce(text, '')), chr(10)) as lines from documents),
    u as (select doc_id, unnest(lines) as unit from l union all select doc_id, array_to_string(lines, ' ') from l where len(lines) > 1),
    w as (select doc_id, string_split(trim(regexp_replace(unit, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') as w from u),
    g as (
        select doc_id, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as g from w where len(w) > 1
    ),
    text_words as (select doc_id, string_split(trim(regexp_replace(array_to_string(lines, ' '), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') as w from l),
    pairs as (select doc_id, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) as p from text_words where len(w) > 1),
    places as (select doc_id, p, unnest(range(1, len(p) + 1)) as i, unnest(p) as pair from pairs),
    grams_of as (select license, grams, n, unnest(grams) as pair from t),
    stretches as (select doc_id, license, grams, list_distinct(p[i:i + n - 1]) as g from places join grams_of using (pair)),
    m as (
        select doc_id, license, 2.0::double * len(list_intersect(g, grams)) / (len(g) + len(grams)) as dice from g, t
        union all select doc_id, license, 2.0::double * len(list_intersect(g, grams)) / (len(g) + len(grams)) from stretches
    ),
    best as (
        select doc_id, count(distinct license) as n_matches, max(dice) as dice from m where dice >= {licenses.LEAST} group by 1
    ),
    named as (select doc_id, min(license) as license from m join best using (doc_id, dice) group by 1)
    select doc_id, license, coalesce(dice, 0)::double as dice, coalesce(n_matches, 0)::bigint as n_matches
    from documents left join best using (doc_id) left join named using (doc_id)
    """


@query("op3_license_scan", _oracle_3())
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    best = F.get("matches", F.lit(0))
    return found.select(
        "doc_id",
        best["license"].alias("license"),
        F.coalesce(best["dice"], F.lit(0.0)).alias("dice"),
        F.size("matches").cast("long").alias("n_matches"),
    )


#: crc32 of an id's decimal text: the polynomial's table, then one step a character.
CRC_CTES = """
    crc_table as (
        select list(c order by i) as crc_of from (
            select i, list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c
            from (select unnest(range(256))::bigint as i)
        )
    ),
    crc as (
        select doc_id, coalesce(xor(list_reduce(
            [4294967295::bigint] || list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint),
            lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255) + 1])
        ), 4294967295), 0) as h
        from (select distinct doc_id from documents), crc_table
    )
    """


def crc32_of_id() -> Column:
    """Unsigned crc32 of the decimal ``doc_id``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary"))


MERKLE_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def _oracle_13() -> str:
    def field(value: str) -> str:
        return f"coalesce(strlen(({value})::varchar)::varchar || ':' || ({value})::varchar, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(text if f == "text" else f) for f in MERKLE_FIELDS) + ")"

    # trees of up to 16 ** 6 nodes: `u` levels of one tree a source, then `t` levels over the subroots
    ctes = [
        CRC_CTES,
        f"""leaves as (
            select doc_id, row_number() over (partition by source order by doc_id nulls first, {leaf("text")}) - 1 as place, coalesce('=' || source, '') as tree,
                   {leaf("text")} as leaf, case when crc.h % 5 = 0 then {leaf(LOWER.format("text"))} else {leaf("text")} end as claimed
            from documents left join crc using (doc_id)
        )""",
        "u0 as (select tree, place, leaf as node, count(*) over (partition by tree) as n from leaves)",
    ]
    depth = 6
    for t, first in (("u", None), ("t", f"select '' as tree, row_number() over (order by tree) - 1 as place, node, count(*) over () as n from u{depth}")):
        if first:
            ctes.append(f"t0 as ({first})")
        for k in range(1, depth + 1):
            ctes.append(f"""{t}{k} as (
                select tree, place // 16 as place, case when n = 1 then min(node) else sha256(string_agg(node, '' order by place)) end as node, (n + 15) // 16 as n
                from {t}{k - 1} group by tree, n, place // 16
            )""")
    steps = [("u", k, "tree", f"place // {16**k}") for k in range(depth)] + [("t", k, "''", f"top // {16**k}") for k in range(depth)]
    ctes.append(f"names as (select tree, row_number() over (order by tree) - 1 as top, node as subroot from u{depth})")
    ctes.append("w0 as (select leaves.*, top, subroot, claimed as folded, '' as proof from leaves join names using (tree))")
    for i, (t, k, tree, place) in enumerate(steps):
        ctes.append(f"""runs{i} as (select tree as run_tree, place // 16 as run, list(node order by place) as nodes from {t}{k} where n > 1 group by all)""")
        ctes.append(f"""w{i + 1} as (
            select w.* exclude (folded, proof, nodes, lft, rgt), proof || coalesce(array_to_string(lft || rgt, ''), '') as proof,
                   case when nodes is null then folded else sha256(array_to_string(lft, '') || folded || array_to_string(rgt, '')) end as folded
            from (
                select w{i}.*, nodes, nodes[1:({place}) % 16] as lft, nodes[({place}) % 16 + 2:] as rgt
                from w{i} left join runs{i} on run_tree = {tree} and run = ({place}) // 16
            ) w
        )""")
    return f"""
    with {", ".join(ctes)}
    select doc_id, leaf, subroot, t{depth}.node as root, sha256(proof) as proof_sha256, folded as folded_root, folded = t{depth}.node as verified
    from w{len(steps)}, t{depth}
    """


@query("op13_merkle_manifest", _oracle_13())
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = merkle.leaf([lowered if f == "text" else F.col(f) for f in MERKLE_FIELDS])
    rows = merkle.manifest(table(spark, sf_dir, "documents"), MERKLE_FIELDS, "source", "doc_id", F.when(crc32_of_id() % 5 == 0, tampered))
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


ORACLE_11 = f"""
    with {CRC_CTES},
    raw as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
    sized as (select doc_id, w, len(w) as n, h, h // 10 as g from raw left join crc using (doc_id)),
    d as (
        select doc_id, case when h % 10 = 0 and n > 0
            then list_transform(range(n), lambda i: case when i < g % n then w[i + 1] else w[g % n + (i - g % n) % (1 + (n - g % n) // (3 + g % 8)) + 1] end)
            else w end as w
        from sized
    ),
    words as (select doc_id, unnest(w) as word, unnest(range(len(w))) as i, len(w) as n from d),
    equal as (select a.doc_id, b.i - a.i as q, a.i from words a join words b on a.doc_id = b.doc_id and a.word = b.word and a.i < b.i and b.i - a.i <= a.n // 4),
    islands as (select doc_id, q, i, i - row_number() over (partition by doc_id, q order by i) as island from equal),
    repeats as (select doc_id, q, min(i) as start, count(*) + q as length from islands group by doc_id, q, island having count(*) + q >= greatest(6, 4 * q)),
    runs as (select doc_id, start, length, min(q) as period from repeats group by 1, 2, 3),
    gone as (select distinct doc_id, unnest(range(start + period, start + length)) as i from runs),
    kept as (select doc_id, string_agg(word, ' ' order by i) as text from words anti join gone using (doc_id, i) group by 1),
    listed as (select doc_id, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as list from runs group by 1),
    longest as (select * from runs qualify row_number() over (partition by doc_id order by length desc, start, period) = 1)
    select doc_id, coalesce(n_runs, 0)::bigint as n_runs, start::bigint as start, length::bigint as length, period::bigint as period,
           (1000 * length // period)::bigint as exponent_milli, sha256(coalesce(list, '')) as runs_sha256, sha256(coalesce(kept.text, '')) as collapsed_sha256
    from documents left join listed using (doc_id) left join longest using (doc_id) left join kept using (doc_id)
    """


def with_repeats(docs: DataFrame) -> DataFrame:
    """``documents`` where every text whose id's crc32 is divisible by ten repeats words from some place on, as the query is given them."""
    h = crc32_of_id()
    words = F.when(h % 10 == 0, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    n, g = F.size("words"), F.floor(h / 10)
    first = F.when(n > 0, g % n)
    period = 1 + F.floor((n - F.col("first")) / (3 + g % 8))

    def repeated(word: Column, i: Column) -> Column:
        source = F.col("first") + (i - F.col("first")) % F.col("period") + 1
        return F.when(i < F.col("first"), word).otherwise(F.element_at("words", source.cast("int")))

    planned = docs.withColumn("words", words).withColumn("first", first).withColumn("period", period)
    text = F.when(F.col("period").isNull(), F.col("text")).otherwise(F.array_join(F.transform("words", repeated), " "))
    return planned.select("doc_id", text.alias("text"))


@query("op11_periodic_runs", ORACLE_11)
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find(with_repeats(table(spark, sf_dir, "documents")))
    longest = F.get(F.array_sort("runs", lambda a, b: F.when(a["length"] != b["length"], F.signum(b["length"] - a["length"])).when(a["start"] != b["start"], F.signum(a["start"] - b["start"])).otherwise(F.signum(a["period"] - b["period"])).cast("int")), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *(r[f].cast("string") for f in ("start", "length", "period"))))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"longest.{f}").alias(f) for f in ("start", "length", "period")),
        F.floor(F.lit(1000).cast("long") * F.col("longest.length") / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query(
    "op12_substring_dedup",
    """
    with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
    windows as (select doc_id, i, array_to_string(w[i:i + 19], ' ') as s from (select doc_id, w, unnest(range(1, len(w) - 18)) as i from d where len(w) >= 20)),
    later as (select doc_id, i from windows qualify row_number() over (partition by s order by doc_id, i) > 1),
    gone as (select distinct doc_id, unnest(range(i, i + 20)) as i from later),
    words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from d),
    kept as (select doc_id, string_agg(word, ' ' order by i) as text, count(*) as n from words anti join gone using (doc_id, i) group by 1)
    select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
    from d left join kept using (doc_id)
    """,
)
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = debruijn.remove(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
