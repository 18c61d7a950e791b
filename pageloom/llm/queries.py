"""The queries of the operators in this folder and the SQL that states their results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm import decontaminate as DC
from pageloom.llm import html_text as H
from pageloom.llm import language as L
from pageloom.llm import language_model as LM
from pageloom.llm import mixing as MX
from pageloom.llm import ngram_join as NG
from pageloom.llm import periodic_runs as PR
from pageloom.llm import quality as QU
from pageloom.llm import simhash_join as SH
from pageloom.llm import spelling as SP
from pageloom.llm import token_counts as TC
from pageloom.llm import toxicity as TX
from pageloom.llm import url_filter as U
from pageloom.llm.text import SPACED_WORD, held_out

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


URL_RULES = (
    U.UrlRule("block", "net/"),
    U.UrlRule("allow", "example.net/en/"),
    U.UrlRule("block", "example.com/de/"),
    U.UrlRule("allow", "org/fr/"),
)


def _url_sql() -> str:
    low = "translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    has = lambda term: f"regexp_matches(u, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')::int"
    strict = " + ".join(has(t) for t, w in U.TERMS.items() if w >= U.STRICT)
    soft = " + ".join(has(t) for t, w in U.TERMS.items() if w < U.STRICT)
    fits = " ".join(
        f"when (host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}') then '{r.text}'"
        for r in sorted(URL_RULES, key=lambda r: -len(r.text))
    )
    kinds = " ".join(f"when '{r.text}' then '{r.verdict}'" for r in URL_RULES)
    return f"""
with parts as (
  select page_id, coalesce({low}, '') as u,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
found as (select *, case {fits} end as rule, {strict} as hard, {soft} as n_soft from parts)
select page_id, host, path, rule,
  case when rule is not null then case rule {kinds} end when hard > 0 or n_soft >= 2 then 'block' else 'allow' end as verdict,
  n_soft
from found"""


@query("op10_url_filter", _url_sql())
def op10_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url")
    return U.url_verdicts(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "n_soft")


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP3_SQL = f"""
with item_words as (select item_id, {_WORDS} as w from benchmark where text is not null),
windows as (
  select distinct item_id, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') as win, least(10, len(w)) as n
  from (select item_id, w, unnest(range(1, greatest(2, len(w) - 8))) as i from item_words where len(w) > 0)),
doc_words as (select doc_id, case when text is null then [] else {_WORDS} end as w from documents),
spans as (
  select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') as win
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from doc_words, (select distinct n from windows)
        where len(w) >= n)),
met as (select s.doc_id, s.i, s.n, w.item_id from spans s join windows w on s.win = w.win and s.n = w.n),
hit as (select doc_id, count(distinct word) as n_hit
  from (select distinct doc_id, unnest(range(i, i + n)) as word from met) group by doc_id),
ids as (select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct doc_id, item_id::varchar as id from met) group by doc_id)
select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc_words d left join hit using (doc_id) left join ids using (doc_id)"""


@query("op3_benchmark_decontamination", OP3_SQL)
def op3_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return DC.digest(DC.contamination(docs, table(spark, sf, "benchmark")))


@query("op5_source_mix")
def op5_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    return MX.mix(docs).select(
        "doc_id", "size", "source_size", "target", "taken", F.transform("draws", lambda d: d["shard"]).alias("shards")
    )


@query("op7_quality_rules")
def op7_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    trees = QU.fit_quality(docs, table(spark, sf, "labels"))
    return QU.judge(docs, trees).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "bad_score", "kept"
    )


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    found = L.identify(docs.select("doc_id", "text"), L.train(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "ambiguous")


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = TX.score(docs, TX.train(docs, table(spark, sf, "labels")))
    return found.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("toxic_spans").alias("n_spans"),
    )


@query("op6_ngram_jaccard_join")
def op6_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return NG.linked_documents(table(spark, sf, "documents").select("doc_id", "text"))


@query("op1_html_extraction")
def op1_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    return H.main_text(pages).select("page_id", "url", "text", "n_chars", "n_blocks")


@query("op9_lm_scoring")
def op9_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = LM.score_texts(docs, F.crc32(F.col("doc_id").cast("string")) % 10 != 0)
    return found.select(
        "doc_id", held_out("doc_id", 10).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of every document before and after its addresses, numbers and licence lines are replaced."""
    return TC.edited_counts(table(spark, sf, "documents").select("doc_id", "text"))


#: CRC-32 in SQL: the table of the reflected polynomial, and the fold of a list of bytes over it.
_CRC_TABLE = """crc as (
  select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as tab
  from (select unnest(range(256)) as i))"""


def _crc_sql(byte_list: str) -> str:
    return f"xor(list_reduce(list_prepend(4294967295, {byte_list}), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"


_ID_BYTES = "list_transform(string_split(doc_id::varchar, ''), lambda x: ord(x)::bigint)"
OP11_SQL = f"""
with {_CRC_TABLE},
hashed as (select doc_id, text, case when doc_id is not null then {_crc_sql(_ID_BYTES)} end as h from documents, crc),
split as (select doc_id, h, h // 10 as g, coalesce(regexp_extract_all(text, '{SPACED_WORD}'), []) as w from hashed),
sized as (select doc_id, w, len(w) as n, h % 10 = 0 and len(w) > 0 as planted, g % nullif(len(w), 0) as a, g from split),
bodies as (select doc_id, n, w, planted, a, 1 + (n - a) // (3 + g % 8) as p from sized),
docs as (select doc_id, n, case when planted then list_transform(range(n), lambda i: w[case when i < a then i else a + (i - a) % p end + 1]) else w end as w from bodies),
flat as (select doc_id, unnest(w) as word, unnest(range(n)) as i, n from docs),
pairs as (select a.doc_id, a.i, b.i - a.i as q from flat a join flat b on a.doc_id = b.doc_id and a.word = b.word and b.i > a.i and 4 * (b.i - a.i) <= a.n),
grouped as (select doc_id, q, i, i - row_number() over (partition by doc_id, q order by i) as island from pairs),
stretches as (select doc_id, min(i) as start, count(*) + q as length, q as period from grouped group by doc_id, q, island having count(*) + q >= greatest(6, 4 * q)),
runs as (select doc_id, start, length, min(period) as period from stretches group by doc_id, start, length),
digests as (select doc_id, count(*) as n_runs, sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period)) as runs_sha256 from runs group by doc_id),
best as (select * from (select *, row_number() over (partition by doc_id order by length / period::double desc, start, period) as place from runs) where place = 1),
dropped as (select distinct doc_id, unnest(range(start + period, start + length)) as i from runs),
kept as (select doc_id, string_agg(word, ' ' order by i) as body from flat anti join dropped using (doc_id, i) group by doc_id)
select d.doc_id, coalesce(n_runs, 0) as n_runs, b.start, b.length, b.period, 1000 * b.length // b.period as exponent_milli,
  coalesce(runs_sha256, sha256('')) as runs_sha256, sha256(coalesce(body, '')) as collapsed_sha256
from docs d left join digests using (doc_id) left join best b using (doc_id) left join kept using (doc_id)"""


def planted_periods(docs: DataFrame) -> DataFrame:
    """A tenth of the texts, chosen by ``crc32`` of the id, repeats a stretch of its words from some place on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(SPACED_WORD), F.lit(0))
    n, g = F.size(words), F.floor(h / 10)
    a = F.try_mod(g, n).cast("int")
    p = F.floor(1 + (n - a) / (3 + g % 8)).cast("int")
    whole = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.floor((n - a) / p).cast("int")))
    again = F.array_join(F.concat(F.slice(words, F.lit(1), a), whole, F.slice(words, a + 1, (n - a) % p)), " ")
    return docs.withColumn("text", F.when((h % 10 == 0) & (n > 0), again).otherwise(F.col("text")))


@query("op11_periodic_runs", OP11_SQL)
def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return PR.digest(PR.periodic_runs(planted_periods(docs)))


@query("op12_simhash_near_dedup")
def op12_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return SH.near_duplicates(table(spark, sf, "documents").select("doc_id", "text"))


_RUN_BYTES = "list_transform(range(len(hx) // 2), lambda i: ('0x' || hx[2 * i + 1 : 2 * i + 2])::bigint)"
OP13_SQL = f"""
with recursive {_CRC_TABLE},
runs as (select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{7,}}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
  from documents where text is not null),
coded as (select run, hex(encode(doc_id::varchar || ':' || run)) as hx from runs),
hashed as (select run, case when hx is not null then {_crc_sql(_RUN_BYTES)} end as h from coded, crc),
altered as (select case when h % 31 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word from hashed),
words as (select word, count(*) as n from altered where length(word) >= 7 group by word having count(*) >= 2),
cuts as (select word, i, substr(word, 1, i::int) || substr(word, i::int + 2) as rest from (select word, unnest(range(length(word))) as i from words)),
near as (
  select c.word, w.word as other from cuts c join words w on c.rest = w.word
  union select w.word, c.word from cuts c join words w on c.rest = w.word
  union select a.word, b.word from cuts a join cuts b on a.rest = b.rest and a.i = b.i and a.word <> b.word),
told as (select near.word, other, w.n as m, count(*) over (partition by near.word) as n_near,
    row_number() over (partition by near.word order by w.n desc, other) as place
  from near join words w on w.word = other),
formed as (select w.word, w.n, coalesce(t.n_near, 0) as n_near,
    case when m >= 10 * n then other end as form, case when m >= 10 * n then m end as form_n
  from words w left join told t on t.word = w.word and place = 1),
way as (select word, word as root from formed union all select way.word, f.form from way join formed f on f.word = way.root where f.form is not null)
select f.word, f.form, r.root, f.n, f.n_near, f.form_n
from formed f join (select way.word, root from way join formed g on g.word = root where g.form is null) r on r.word = f.word"""


def lost_letter(run: Column) -> Column:
    """Every 31st run, chosen by ``crc32`` of id and run, lacks a letter; a null id leaves runs as they are."""
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    return F.when(h % 31 == 0, F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.length(run)))).otherwise(run)


@query("op13_spelling_variants", OP13_SQL)
def op13_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Words with their near words and forms, after letters were lost."""
    words = SP.word_counts(table(spark, sf, "documents").select("doc_id", "text"), alter=lost_letter)
    return SP.spelling_forms(words).select("word", "form", "root", "n", "n_near", "form_n")
