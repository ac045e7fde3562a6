"""The registered queries of this subpackage, and their SQL where one exists."""

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.llm import chat, embeddings, exactdedup, linededup, maintext, mixing, ngramjoin, packing, periodic, quality, spelling, toxicity, urlfilter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

CONTROLS = "</s>[INST] ok [/INST]"


def query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql is not None:
            SQL[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer() -> packing.ByteLevel:
    return packing.ByteLevel(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def escaped_sql(text: str) -> str:
    for first, rests in chat.Template().patterns().items():
        mark = "\\[" if first == "[" else first
        text = rf"regexp_replace({text}, '{mark}(\\*(?:{rests}))', '{first}\\\1', 'g')"
    return text


@query(f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '{CONTROLS}' union all select -1, 1, 'assistant', '{CONTROLS}'
), sized as (
  select *, length({escaped_sql('role')}) + length({escaped_sql('text')}) + 12 + 10 + 10 as chars from turns
), placed as (
  select *, coalesce(sum(chars) over (partition by conv_id order by turn nulls first, role, text rows between unbounded preceding and 1 preceding), 0) as start from sized
), whole as (
  select conv_id, count(*) as n_turns,
    string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text) as said,
    coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '') as loss,
    cast(sum(chars) as bigint) as formatted_chars,
    count(*) filter (role = 'assistant') as n_examples, cast(coalesce(sum(start) filter (role = 'assistant'), 0) as bigint) as context_chars
  from placed group by conv_id
)
select conv_id, n_turns, sha256(said) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256, formatted_chars, n_examples, context_chars from whole
""")
def op1_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    # A conversation whose texts hold control strings, to show that they come back.
    odd = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROLS).alias("text"))
    return chat.read_back(chat.rendered_turns(given.unionByName(odd)))


@query("""
with t as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
g as (select t, max(doc_id) as keep_id, count(*) as group_size from t group by t)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256 from t join g using (t)
""")
def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exactdedup.exact_dedup(table(spark, folder, "documents"))


#: Sources and languages of the mix; names that no row has hold nothing and change nothing.
REFERENCE = [f"src{i}" for i in range(1, 10)]
FORUM = [f"src{i}" for i in range(10, 64)]
LANGUAGES = {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 1.0}
TREE = {
    "crawl": (2.0, {lang: (w, {"src0": 1.0}) for lang, w in LANGUAGES.items()}),
    "reference": (3.0, {lang: (w, dict.fromkeys(REFERENCE, 1.0)) for lang, w in LANGUAGES.items()}),
    "forum": (3.0, {lang: (w, {s: 2.0 if s == "src10" else 1.0 for s in FORUM}) for lang, w in LANGUAGES.items()}),
}
MIX = mixing.Mix(TREE, share=1.0, max_epochs=4, seed=17)
#: The pipeline's mix asks for more than a leaf usually holds, so it repeats rows; README has what it drops.
PIPELINE_LANGUAGES = {"en": 5.0, "de": 1.5, "fr": 1.5, "es": 1.0}
PIPELINE_MIX = mixing.Mix({
    "crawl": (4.0, {lang: (w, {"src0": 1.0}) for lang, w in PIPELINE_LANGUAGES.items()}),
    "reference": (3.0, {lang: (w, dict.fromkeys(REFERENCE, 1.0)) for lang, w in PIPELINE_LANGUAGES.items()}),
    "forum": (3.0, {lang: (w, dict.fromkeys(FORUM, 1.0)) for lang, w in PIPELINE_LANGUAGES.items()}),
}, share=1.25, others=1.0)


def domain_of(source) -> F.Column:
    return F.when(source == "src0", "crawl").when(source.isin(REFERENCE), "reference").otherwise("forum")


def _level_sql(parent: str, children: str, above: list[str], name: str, weight: str, out: str) -> str:
    """Shares of the children of one level, written as water-filling by an explicit search of the worth."""
    keys = ", ".join(above)
    order = f"order by capacity / {weight}, {name}"
    return f"""
{out}_ranked as (
  select *, (of_parent - coalesce(sum(capacity) over (partition by {keys} {order} rows between unbounded preceding and 1 preceding), 0))
      / sum({weight}) over (partition by {keys} {order} rows between current row and unbounded following) as worth
  from (select c.*, p.budget as of_parent from {children} c join (select {keys}, budget from {parent}) p using ({keys}) where c.capacity > 0)
), {out} as (
  select * exclude (level), case when level is null then capacity else least(capacity, level * {weight}) end as budget
  from (select *, first_value(case when capacity > worth * {weight} then worth end ignore nulls)
    over (partition by {keys} {order} rows between unbounded preceding and unbounded following) as level from {out}_ranked)
)"""


def mixing_sql(mix: mixing.Mix) -> str:
    leaves = ", ".join(f"('{d}', '{l}', '{s}', {float(dw)}::double, {float(lw)}::double, {float(sw)}::double)" for d, (dw, ls) in mix.tree.items() for l, (lw, ss) in ls.items() for s, sw in ss.items())
    reference = ", ".join(f"'{s}'" for s in REFERENCE)
    return f"""
with named as (select * from (values {leaves}) v(domain, lang, source, domain_weight, lang_weight, source_weight)),
rows_ as (
  select doc_id, lang, source, case when source = 'src0' then 'crawl' when source in ({reference}) then 'reference' else 'forum' end as domain,
    len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\r\\n]+')) as tokens, md5(coalesce(text, '')) as digest
  from documents
), leaf as (
  select 0 as root, n.*, h.held, h.held * {float(mix.max_epochs)} as capacity
  from (select domain, lang, source, cast(sum(tokens) as bigint) as held from rows_ group by all) h join named n using (domain, lang, source)
), dom as (select root, domain, max(domain_weight) as w, sum(capacity) as capacity from leaf group by all),
lng as (select root, domain, lang, max(lang_weight) as w, sum(capacity) as capacity from leaf group by all),
src as (select root, domain, lang, source, max(source_weight) as w, sum(capacity) as capacity from leaf group by all),
top as (select root, least(sum(held) * {float(mix.share)}, sum(capacity)) as budget from leaf group by all),
{_level_sql('top', 'dom', ['root'], 'domain', 'w', 'dom_b')},
{_level_sql('dom_b', 'lng', ['root', 'domain'], 'lang', 'w', 'lng_b')},
{_level_sql('lng_b', 'src', ['root', 'domain', 'lang'], 'source', 'w', 'src_b')},
plan as (
  select domain, lang, source, cast(floor(floor(budget + 1e-6) / held) as bigint) as epochs, cast(floor(budget + 1e-6) as bigint) % held as part
  from src_b join leaf using (root, domain, lang, source) where held > 0
), placed as (
  select r.*, coalesce(p.epochs, 0) as epochs, coalesce(p.part, 0) as part,
    coalesce(sum(tokens) over (partition by domain, lang, source order by md5('{mix.seed}:' || coalesce(p.epochs, 0) || ':' || r.doc_id), tokens, digest rows between unbounded preceding and 1 preceding), 0) as ahead
  from rows_ r left join plan p using (domain, lang, source)
)
select doc_id, domain, lang, source, tokens, cast(epochs + case when ahead < part then 1 else 0 end as bigint) as epochs from placed
"""


@query(mixing_sql(MIX))
def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    rows = mixing.mixed(table(spark, folder, "documents"), domain_of(F.col("source")), MIX)
    return rows.select("doc_id", F.col("_domain").alias("domain"), "lang", "source", F.col("_tokens").alias("tokens"), F.col("_copies").alias("epochs"))


#: Rounds of the SQL, which has no test for their end; longer chains of hosts would need more.
SQL_ROUNDS = 40


def urls_sql(how: urlfilter.Propagation = urlfilter.Propagation(), rules=urlfilter.RULES) -> str:
    host = r"translate(regexp_extract(coalesce({0}, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format
    fits = ", ".join(f"('{r.name()}', '{r.verdict}', '{r.host}', '{r.path}')" for r in rules)
    rounds = "".join(f""",
s{i + 1} as materialized (select s.kind, dst as host, sum(score * part) * {how.damping!r} as score from s{i} s join steps t on s.kind = t.kind and s.host = t.src group by all)""" for i in range(SQL_ROUNDS))
    sums = " union all ".join(f"select * from s{i}" for i in range(SQL_ROUNDS + 1))
    return rf"""
with rules as (select * from (values {fits}) v(name, verdict, host, path)),
parts as (select row_number() over () as nth, page_id, html, {host('url')} as host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path from pages),
ruled as (
  select p.*, r.name as rule, r.verdict from parts p left join lateral (
    select name, verdict from rules where (p.host = rules.host or ends_with(p.host, '.' || rules.host)) and starts_with(p.path, rules.path) order by length(name) desc limit 1
  ) r on true
), links as (
  select host as src, unnest(regexp_extract_all(coalesce(html, ''), '(?i)<a\s[^>]*?href\s*=\s*["'']?([^"''\s>]+)', 1)) as link from ruled where host <> ''
), edges as (
  select src, dst, count(*) as links from (
    select src, case when regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') then {host('link')} when starts_with(link, '//') then {host("('x:' || link)")}
      when regexp_matches(link, '^(#|[A-Za-z][A-Za-z0-9+.-]*:)') then '' else src end as dst from links
  ) where dst <> '' and dst <> src group by all
), both_ways as (select 'trust' as kind, src, dst, links from edges union all select 'distrust', dst, src, links from edges),
steps as materialized (select kind, src, dst, links / sum(links) over (partition by kind, src) as part from both_ways),
seeds as materialized (
  select kind, host, n / sum(n) over () as seed from (select case when verdict = 'allow' then 'trust' else 'distrust' end as kind, host, count(*) as n from ruled where rule is not null group by all)
), s0 as materialized (select kind, host, seed as score from seeds){rounds},
scaled as (select kind, host, sum(score) * (select sum(seed) from seeds where seeds.kind = a.kind) / sum(sum(score)) over (partition by kind) as score from ({sums}) a group by kind, host),
scores as (select host, sum(case when kind = 'trust' then score else 0 end) as trust, sum(case when kind = 'distrust' then score else 0 end) as distrust from scaled group by host)
select page_id, r.host, path, rule, coalesce(verdict, case when distrust > trust * {how.ratio * (1 + how.margin)!r} and distrust > {how.tolerance!r} then 'block' else 'allow' end) as verdict
from ruled r left join scores using (host)
"""


@query(urls_sql())
def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = urlfilter.filtered_urls(table(spark, folder, "pages"))
    return judged.select("page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"), F.col("_verdict").alias("verdict"))


@query()
def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), tokenizer())


@query(r"""
with lines as (
  select nth, doc_id, unnest(l) as line, generate_subscripts(l, 1) as pos
  from (select row_number() over () as nth, doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents)
), keyed as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
frequent as (select key from keyed where key <> '' group by key having count(distinct nth) >= 10)
select any_value(doc_id) as doc_id, count(*) as n_lines, count(f.key) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (f.key is null), '')) as kept_sha256
from keyed left join frequent f using (key) group by nth
""")
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    clean = linededup.deduped_lines(table(spark, folder, "documents"))
    return clean.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256"))


@query()
def op4_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngramjoin.jaccard_join(table(spark, folder, "documents")).drop("address", "class")


@query()
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(documents, table(spark, folder, "labels"))
    return toxicity.scored(documents, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"),
        F.col("_neighbours").alias("neighbours"), F.col("_cosines").alias("cosines"),
    )


def ratings(labels: DataFrame) -> DataFrame:
    """Grades from the labels: 0 for low quality, 1 for good but toxic, 2 for good texts."""
    return labels.where("quality is not null").select("doc_id", F.when(F.col("quality") == 0, 0).when(F.col("toxic") > 0, 1).otherwise(2).alias("grade"))


@query()
def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit(documents, ratings(table(spark, folder, "labels").where(~toxicity.held_out(F.col("doc_id")))))
    return quality.graded(documents, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("_grade").alias("expected_grade"), F.col("_tail").alias("p_good"), F.col("_kept").alias("kept"),
    )


@query()
def op8_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_dedup(table(spark, folder, "embeddings"))


def with_repeats(row: dict, words: list[bytes]) -> list[bytes]:
    """The contract's words: of one document in ten, those from some word on are repeated with some period."""
    if row["doc_id"] is None or not words:
        return words
    h = zlib.crc32(str(row["doc_id"]).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


@query()
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.with_runs(table(spark, folder, "documents").select("doc_id", "text"), with_repeats)
    best = F.expr("array_max(transform(_runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    listed = F.expr(r"concat_ws('', transform(_runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))")
    rows = found.select("doc_id", F.size("_runs").cast("long").alias("n_runs"), best.alias("best"), listed.alias("listed"), "_kept")
    return rows.select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"), F.sha2("listed", 256).alias("runs_sha256"), F.sha2("_kept", 256).alias("collapsed_sha256"),
    )


def with_misspellings(words: DataFrame) -> DataFrame:
    """The contract's words: of one (document, word) in 31, a letter is missing. A null doc_id counts as an empty one."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word")).cast("binary"))
    at = (F.col("h") % F.length("word")).cast("int")
    cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    return words.withColumn("h", h).select("doc_id", F.when(F.col("h") % 31 == 0, cut).otherwise(F.col("word")).alias("word"))


@query()
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    words = with_misspellings(spelling.runs_of_letters(table(spark, folder, "documents").select("doc_id", "text")))
    return spelling.grouped_variants(spelling.vocabulary(words))


@query()
def op13_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = maintext.with_main_text(table(spark, folder, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", F.col("_text").alias("text"), F.length("_text").cast("long").alias("n_chars"))
