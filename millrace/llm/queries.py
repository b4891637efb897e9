"""The registered queries of this subpackage, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import ball_tree, decontaminate, language, licences, line_dedup, line_quality, minhash, ngram_join, phrases, pieces, quality_rules, toxicity, whitening
from millrace.llm.sampling import labelled_sample

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(of: int):
    """crc32 of the id as text, modulo `of`; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string")) % of


@query
def op1_repeated_phrases(spark, sf_dir):
    found = phrases.dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op2_line_field(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = line_quality.learn(labelled_sample(docs, table(spark, sf_dir, "labels"), "quality", fold(5) != 0, line_quality.FIT_ROWS))
    return line_quality.predict(docs, model, ["doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out")])


@query
def op3_licence_scan(spark, sf_dir):
    return licences.scan(table(spark, sf_dir, "documents"))


@query
def op4_repetition_rules(spark, sf_dir):
    return quality_rules.repetition_rules(table(spark, sf_dir, "documents"))


@query
def op5_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language.learn(docs.where(fold(4) != 2))
    return language.predict(docs, model, ["doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out")])


@query
def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(labelled_sample(docs, table(spark, sf_dir, "labels"), "toxic", fold(4) != 2, toxicity.FIT_ROWS))
    return toxicity.predict(docs, model, ["doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out")])


@query
def op7_merge_dropout(spark, sf_dir):
    found = pieces.encode(table(spark, sf_dir, "documents"), ["doc_id"], pieces.load_vocabulary())
    return found.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("bigint").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), "decoded_same")


@query
def op8_decontaminate(spark, sf_dir):
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", decontaminate.hit_words().alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )


@query
def op9_fuzzy_lines(spark, sf_dir):
    return line_dedup.removals(table(spark, sf_dir, "documents"))


@query
def op10_ngram_join(spark, sf_dir):
    return ngram_join.jaccard_groups(table(spark, sf_dir, "documents"))


@query
def op11_minhash(spark, sf_dir):
    return minhash.near_copies(table(spark, sf_dir, "documents"))


@query
def op12_ball_tree(spark, sf_dir):
    return ball_tree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _sql_canonical(text: str, whole: bool) -> str:
    text = f"lower({text})"
    if whole:
        text = f"regexp_replace({text}, '{licences.COPYRIGHT_LINE}', chr(10), 'g')"
    text = f"regexp_replace({text}, '{licences.NOT_WORD}', '', 'g')"
    for one, other in licences.SPELLINGS:
        text = f"replace({text}, '{one}', '{other}')"
    return text


def _sql_known(texts: list[tuple[str, str]], whole: bool) -> str:
    rows = ", ".join(f"({_sql_text(k)}, {_sql_text(v)})" for k, v in sorted(texts))
    return f"select known, min(name) as name from (select name, sha256({_sql_canonical('t', whole)}) as known from (values {rows}) v(name, t)) group by known"


SQL["op3_licence_scan"] = f"""
with licence as ({_sql_known(licences.whole_texts(), True)}), notice as ({_sql_known(list(licences.NOTICES.items()), False)}),
doc as (select doc_id, nullif({_sql_canonical("text", True)}, '') as c from documents),
line as (select doc_id, {_sql_canonical("unnest(string_split(text, chr(10)))", False)} as c from documents),
marked as (select doc_id, string_agg(distinct name, ',' order by name) as notices, count(*) as n from line join notice on known = sha256(c) where c <> '' group by doc_id)
select doc.doc_id, sha256(doc.c) as canonical_sha256, licence.name as license, coalesce(marked.notices, '') as notices, coalesce(marked.n, 0) as n_notice_lines
from doc left join licence on known = sha256(doc.c) left join marked on marked.doc_id = doc.doc_id
"""

WORDS = r"coalesce(regexp_extract_all({text}, '[^\x20\x09-\x0D]+'), [])"
LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ITEM_WORDS = r"coalesce(regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])".format(text=LOWER.format(text="text"))


def _sql_runs(n: int, source: str = "d") -> str:
    """Every run of n words of every row of a table with doc_id and w: its place from 1 and its words."""
    return f"select doc_id, p, array_to_string(w[p:p + {n - 1}], ' ') as k from (select doc_id, w, unnest(range(1, len(w) - {n - 2})) as p from {source})"


SQL["op1_repeated_phrases"] = f"""
with d as (select doc_id, {WORDS.format(text='text')} as w from documents),
win as (select doc_id, p, row_number() over (partition by k order by doc_id, p) as r from ({_sql_runs(20)})),
gone as (select distinct doc_id, p + j as p from (select doc_id, p, unnest(range(20)) as j from win where r > 1)),
word as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from d),
kept as (select doc_id, string_agg(word, ' ' order by p) as kept from word anti join gone using (doc_id, p) group by doc_id),
n as (select doc_id, count(*) as n from gone group by doc_id)
select d.doc_id, len(w) as n_words, coalesce(n.n, 0) as n_removed, sha256(coalesce(kept.kept, '')) as kept_sha256
from d left join n using (doc_id) left join kept using (doc_id)
"""

_LENGTHS = quality_rules.NGRAM_SHARES
_COVERED = ", ".join(f"c{n} as (select distinct doc_id, p + j as p from (select doc_id, p, unnest(range({n})) as j from (select *, row_number() over (partition by doc_id, k order by p) as r from ({_sql_runs(n)})) where r > 1))" for n in _LENGTHS)
_CHARS = ", ".join(f"s{n} as (select doc_id, sum(length(word)) as dup_chars_{n} from word join c{n} using (doc_id, p) group by doc_id)" for n in _LENGTHS)
_JOINED = " ".join(f"left join s{n} using (doc_id)" for n in _LENGTHS)
SQL["op4_repetition_rules"] = rf"""
with d as (select doc_id, coalesce(text, '') as text, {WORDS.format(text='text')} as w from documents),
word as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from d),
rep as (select doc_id, count(distinct p + j) as n_repeat_words from (select doc_id, p, unnest(range(3)) as j from (select *, count(*) over (partition by doc_id, k) as n from ({_sql_runs(3)})) where n > 1) group by doc_id),
line as (select doc_id, l, i, length(regexp_replace(l, '[ 	-
]', '', 'g')) as chars from (select doc_id, unnest(string_split(text, chr(10))) as l, unnest(range(len(string_split(text, chr(10))))) as i from d)),
lines as (select doc_id, count(*) as n_lines, sum(chars) as line_chars, count(*) filter (r > 1) as n_dup_lines, coalesce(sum(chars) filter (r > 1), 0) as dup_line_chars
 from (select *, row_number() over (partition by doc_id, l order by i) as r from line where chars > 0) group by doc_id),
{_COVERED}, {_CHARS},
counts as (select d.doc_id, len(w) as n_words, length(regexp_replace(text, '[ 	-
]', '', 'g')) as word_chars, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
 coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_lines, 0) as n_lines, cast(coalesce(line_chars, 0) as bigint) as line_chars, cast(coalesce(dup_line_chars, 0) as bigint) as dup_line_chars,
 {', '.join(f'cast(coalesce(dup_chars_{n}, 0) as bigint) as dup_chars_{n}' for n in _LENGTHS)}
 from d left join rep using (doc_id) left join lines using (doc_id) {_JOINED})
select *, n_words < {quality_rules.MIN_WORDS} or 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words as base_failed,
 not (n_words < {quality_rules.MIN_WORDS} or 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words or n_dup_lines > cast({quality_rules.LINE_SHARE} as double) * n_lines
 or dup_line_chars > cast({quality_rules.LINE_CHAR_SHARE} as double) * line_chars or {' or '.join(f'dup_chars_{n} > cast({share} as double) * word_chars' for n, share in _LENGTHS.items())}) as kept
from counts
"""

SQL["op8_decontaminate"] = f"""
with d as (select doc_id, {ITEM_WORDS} as w from documents),
item as (select coalesce(cast(item_id as varchar), 'null') as item, w, least({decontaminate.WINDOW}, len(w)) as need from (select item_id, {ITEM_WORDS} as w from benchmark) where len(w) > 0),
iw as (select distinct item, need, array_to_string(w[p:p + need - 1], ' ') as k from (select *, unnest(range(1, len(w) - need + 2)) as p from item)),
dw as (select doc_id, need, p, array_to_string(w[p:p + need - 1], ' ') as k from (select doc_id, w, need, unnest(range(1, len(w) - need + 2)) as p from d, (select distinct need from iw))),
hit as (select doc_id, item, p, iw.need from dw join iw using (need, k)),
n as (select doc_id, count(distinct p) as n_hit from (select doc_id, p + unnest(range(need)) as p from hit) group by doc_id),
f as (select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from hit group by doc_id)
select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join n using (doc_id) left join f using (doc_id)
"""



def _sql_groups(n: int, percent: int) -> str:
    """Sets of n-word shingles, their links and what can be reached, up to a table `found` of (doc_id, n_shingles, component_id)."""
    return f"""with recursive d as (select doc_id, {WORDS.format(text=LOWER.format(text='text'))} as w from documents),
s as (select distinct doc_id, k from ({_sql_runs(n)}) union select doc_id, array_to_string(w, ' ') || ' .' from d where len(w) between 1 and {n - 1}),
n as (select doc_id, count(*) as n from s group by doc_id),
link as (select x.doc_id as a, y.doc_id as b from s x join s y on x.k = y.k and x.doc_id <> y.doc_id join n na on na.doc_id = x.doc_id join n nb on nb.doc_id = y.doc_id
 group by x.doc_id, y.doc_id, na.n, nb.n having 100 * count(*) >= {percent} * (na.n + nb.n - count(*))),
reach(a, b) as (select a, b from link union select r.a, l.b from reach r join link l on l.a = r.b),
found as (select d.doc_id, coalesce(max(n.n), 0) as n_shingles, least(d.doc_id, coalesce(min(reach.b), d.doc_id)) as component_id
 from d left join n using (doc_id) left join reach on reach.a = d.doc_id group by d.doc_id)"""


SQL["op10_ngram_join"] = f"""
{_sql_groups(ngram_join.N, ngram_join.PERCENT)}
select doc_id, n_shingles, component_id from found
"""

SQL["op11_minhash"] = f"""
{_sql_groups(minhash.N, minhash.PERCENT)}
select doc_id, n_shingles, component_id, doc_id = component_id as kept from found
"""

SQL["op12_ball_tree"] = f"""
with d as (select doc_id, {ITEM_WORDS} as w from documents),
s as (select count(*) filter (len(w) > 0) as docs, cast(sum(len(w)) as bigint) as total from d),
tf as (select doc_id, n, term, count(*) as tf from (select doc_id, len(w) as n, unnest(w) as term from d) group by all),
df as (select term, cast(floor(1000 * ln(cast(2 * docs + 2 as double) / cast(2 * df + 1 as double))) as bigint) as w from (select term, count(*) as df from tf group by term), s),
item as (select distinct item_id, unnest({ITEM_WORDS}) as term from benchmark),
score as (select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total)))) as bigint) as score
 from item join df using (term) join tf using (term), s group by item_id, doc_id),
ranked as (select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank, doc_id, score from score where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= {ball_tree.TOP}
"""
