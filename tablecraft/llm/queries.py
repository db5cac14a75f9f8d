"""Registered queries of the corpus operators, with oracle SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecraft.llm import bpe, chat, fmindex, lempelziv, linededup, minhash, ranked, repair, simhash, suffixes, toxicity, trie, urls
from tablecraft.llm.frames import KEY, stored, table, text_key
from tablecraft.sources.scratch import scratch_path


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without the 400-byte strings that occur twice."""
    docs = table(spark, sf_dir, "documents")
    cut = suffixes.removed(docs, texts=False).select(*KEY, "n_removed", "n_spans", "kept_sha256")
    own = F.sha2(F.coalesce("text", F.lit("")), 256)
    whole = docs.select("doc_id", *text_key("doc_id", "text"),
                        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), own.alias("own"))
    return whole.join(cut, KEY, "left").select(
        "doc_id", "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "own").alias("kept_sha256"),
    )


RULES = urls.rules(["block net/", "allow example.net/en/", "block example.com/de/", "allow org/fr/"])


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    out = urls.judged(table(spark, sf_dir, "pages"), RULES)
    return out.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "block_score")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered turns of the conversations that are no snapshot of a longer one."""
    out = chat.maximal_conversations(table(spark, sf_dir, "conversations"))
    return out.select(F.col("conv").alias("conv_id"), "position", "n_turns", "role", "segment")


#: A third of the documents never lend their labels to training.
def held_out(doc_id):
    return F.crc32(doc_id.cast("string")) % 3 == 1


def op4_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, trained on the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), held_out(F.col("id")))
    out = docs.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                      toxicity.score("text", model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component and survivor of every document: 4-word shingles, Jaccard of 0.8 or more."""
    out = minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, similarity_pct=80)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept")


def op6_fm_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the benchmark occurs in every document, by windows of 10 words."""
    found = fmindex.contamination("text", table(spark, sf_dir, "benchmark"), window=10)
    docs = table(spark, sf_dir, "documents").select("doc_id", found.alias("f"))
    return docs.select(
        "doc_id", "f.n_words", "f.n_hit",
        F.size("f.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("f.items"), ","), 256).alias("items_sha256"),
        (F.col("f.n_hit") > 0).alias("contaminated"),
    )


def op7_repair_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as compressed id shards and read every document back."""
    path = scratch_path(spark, "shards")
    repair.write_shards(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    out = repair.read_shards(spark, path)
    return out.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the rank file, and the bytes they decode to."""
    where = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", bpe.round_trip("text", *where).alias("t"))
    return docs.select(
        "doc_id",
        F.size("t.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("t.ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("t.decoded", 256).alias("decoded_sha256"),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that 2 % or more of their source's distinct pages have."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = linededup.drop_boilerplate(docs, "source", "text", ratio=0.02, min_pages=5, dropped_col="n_dropped")
    return out.select("doc_id", "n_dropped", F.length("text").cast("long").alias("n_chars_kept"),
                      F.sha2("text", 256).alias("kept_sha256"))


#: 95 of 100 pairs of texts with a similarity of 0.8 are that near, and more of the nearer ones.
NEAR_BITS = simhash.radius_for(0.8)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Likeness of every document's fingerprint to its edited text's and to the next
    document's; for ids divisible by 100 also the number of other documents whose
    fingerprint is as near as those of texts with a similarity of 0.8 are."""
    rows = stored(simhash.half_edits(table(spark, sf_dir, "documents")), "half-edits")
    queries = rows.where("id % 100 = 0")
    copies = rows.groupBy("f1", "f2").agg(F.count(F.lit(1)).alias("copies"))
    near = simhash.within_radius(rows, queries, NEAR_BITS).join(copies, ["f1", "f2"])
    near = near.groupBy("q1", "q2").agg((F.sum("copies") - 1).alias("n_near"))
    # a text's count goes to the rows with its fingerprint: ids may repeat
    near = near.withColumnsRenamed({"q1": "f1", "q2": "f2"})
    others = rows.where("id is null or id % 100 <> 0").withColumn("n_near", F.lit(None).cast("long"))
    return queries.join(near, ["f1", "f2"], "left").unionByName(others).select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256",
        simhash.as_text("f1", "f2").alias("fingerprint"),
        simhash.as_text("e1", "e2").alias("edited_fingerprint"),
        simhash.likeness("f1", "f2", "e1", "e2").alias("near_edited"),
        simhash.likeness("f1", "f2", "n1", "n2").alias("near_next"),
        "n_near",
    )


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without the windows of 35 words that occur twice."""
    out = lempelziv.removed(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents of every benchmark item."""
    out = ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)
    return out.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations, rebuilt on the turns of every fifth."""
    turns = trie.turns_in_order(table(spark, sf_dir, "conversations"))
    c = F.col("conv")
    out = trie.prefix_trie(*trie.rebuilt(turns, base=c - c % 5, shared=F.crc32(c.cast("string")) % 9))
    return out.withColumnRenamed("saved_bytes", "saved_tokens")


#: Lower-cases A-Z only, as the contracts say; DuckDB's lower() folds other letters too.
_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP5_SQL = f"""
with recursive w as (
  select doc_id, regexp_extract_all({_AZ}, '[^\\x20\\x09-\\x0D]+') as w from documents),
s as (
  select distinct doc_id, array_to_string(w[i:i + 3], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as i from w where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (
  select a.doc_id as a, b.doc_id as b, count(*) as i
  from s a join s b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
l as (
  select p.a, p.b from p join n x on x.doc_id = p.a join n y on y.doc_id = p.b
  where 100 * p.i >= 80 * (x.n + y.n - p.i)),
r as (
  select doc_id as d, doc_id as c from w
  union
  select l.b, r.c from r join l on l.a = r.d where r.c < l.b)
select w.doc_id, coalesce(n.n, 0) as n_shingles, m.c as component_id, w.doc_id = m.c as kept
from w left join n on n.doc_id = w.doc_id join (select d, min(c) as c from r group by d) m on m.d = w.doc_id
"""

_OP6_WORDS = f"regexp_extract_all({_AZ}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_OP6_SQL = f"""
with d as (select doc_id, {_OP6_WORDS} as w from documents),
b as (select item_id, {_OP6_WORDS} as w from benchmark),
p as (
  select distinct item_id, w[i:i + 9] as p, least(len(w), 10) as n
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0)),
lengths as (select distinct n from p),
g as (
  select doc_id, n, i, w[i:i + n - 1] as p
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, lengths where len(w) >= n)),
o as (select g.doc_id, g.i, g.n, p.item_id from g join p on p.p = g.p and p.n = g.n),
h as (
  select doc_id, count(distinct k) as n_hit
  from (select doc_id, unnest(range(i, i + n)) as k from o) group by doc_id),
t as (
  select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct doc_id, item_id::varchar as id from o) group by doc_id)
select d.doc_id, len(d.w) as n_words, coalesce(h.n_hit, 0) as n_hit, coalesce(t.n_items, 0) as n_items,
  sha256(coalesce(t.ids, '')) as items_sha256, h.n_hit is not null as contaminated
from d left join h on h.doc_id = d.doc_id left join t on t.doc_id = d.doc_id
"""

_OP11_SQL = """
with d as (
  select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
g as (
  select r, i, array_to_string(w[i:i + 34], ' ') as g
  from (select r, w, unnest(range(1, len(w) - 33)) as i from d where len(w) >= 35)),
s as (select r, i from g where g in (select g from g group by g having count(*) > 1)),
h as (select distinct r, unnest(range(i, i + 35)) as k from s),
k as (
  select d.r, count(h.k) as n_removed, string_agg(d.x, ' ' order by d.k) filter (where h.k is null) as kept
  from (select r, unnest(w) as x, unnest(range(1, len(w) + 1)) as k from d) d left join h on h.r = d.r and h.k = d.k
  group by d.r)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(k.n_removed, 0)::bigint as n_removed, sha256(coalesce(k.kept, '')) as kept_sha256
from d left join k on k.r = d.r
"""

_OP12_TERMS = f"regexp_extract_all({_AZ}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
_OP12_SQL = f"""
with d as (
  select row_number() over () as r, doc_id, t, len(t) as n from (select doc_id, {_OP12_TERMS} as t from documents)),
i as (select row_number() over () as q, item_id, {_OP12_TERMS} as t from benchmark),
c as (select count(*) filter (where n > 0)::bigint as docs, sum(n)::bigint as total from d),
p as (select r, term, count(*)::bigint as tf from (select r, unnest(t) as term from d) group by 1, 2),
w as (
  select term, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)))::bigint as w
  from p, c group by term),
k as (select q, term, count(*)::bigint as times from (select q, unnest(t) as term from i) group by 1, 2),
s as (
  select k.q, p.r, sum(k.times * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (25 + (75 * d.n * c.docs) // c.total))))::bigint as score
  from k join w on w.term = k.term join p on p.term = k.term join d on d.r = p.r, c group by 1, 2),
o as (
  select s.q, d.doc_id, s.score, row_number() over (partition by s.q order by s.score desc, d.doc_id nulls first) as rank
  from s join d on d.r = s.r where s.score > 0)
select i.item_id, o.rank::int as rank, o.doc_id, o.score from o join i on i.q = o.q where o.rank <= 10
"""

#: The usual checksum of a text of ASCII characters, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(
  list_concat([4294967295::bigint], list_transform(string_split({c}::varchar, ''), lambda x: ascii(x)::bigint)),
  lambda s, b: list_reduce(list_concat([xor(s, b)], [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
    lambda v, i: xor(v >> 1, (v & 1) * 3988292384))))"""
_OP13_SQL = f"""
with t as (
  select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (
    partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos
  from conversations where conv_id is not null),
z as (select c, max(pos) as n, c - c % 5 as b, {_CRC32.format(c="c")} % 9 as h from t group by c),
v as (
  select z.c, z.b, z.h, case when y.n is null then 0 else least(z.h, y.n) end as taken, z.n - least(z.n, z.h) as own
  from z left join z y on y.c = z.b),
r as (
  select t.c, t.pos - v.h + v.taken as pos, t.role, t.text from t join v on v.c = t.c where t.pos > v.h
  union all
  select v.c, t.pos, t.role, t.text from v join t on t.c = v.b and t.pos <= v.taken),
p as (
  select c, pos as d, text, string_agg(role || chr(31) || text, chr(30)) over (
    partition by c order by pos rows between unbounded preceding and current row) as k
  from r union all select c, 0, '', '' from v),
n as (select d, k, count(*) as m, min(c) as c, strlen(any_value(text)) as bytes from p group by d, k),
u as (
  select n.d, n.k, n.m, n.c, n.bytes, a.c as above
  from n left join p on p.c = n.c and p.d = n.d - 1 left join n a on a.d = n.d - 1 and a.k = p.k),
s as (select above as c, d - 1 as d, count(*) as kids from u where above is not null group by 1, 2),
w as (select u.*, coalesce(s.kids, 0) as kids from u left join s on s.c = u.c and s.d = u.d),
o as (
  select p.d, p.k, sum((w.kids = 0)::int) as leaves, sum((w.m - 1) * w.bytes) as saved
  from w join p on p.c = w.c and p.d <= w.d group by 1, 2),
e as (
  select p.d, p.k, string_agg(p.c::varchar, ',' order by p.c) as ends
  from v join p on p.c = v.c and p.d = v.taken + v.own group by 1, 2)
select w.c as conv_id, w.d::bigint as depth, w.above as parent_conv_id, w.m::bigint as n_convs, w.kids::bigint as n_children,
  o.leaves::bigint as n_leaves, o.saved::bigint as saved_tokens, sha256(coalesce(e.ends, '')) as ends_sha256
from w join o on o.d = w.d and o.k = w.k left join e on e.d = w.d and e.k = w.k
"""

_OP3_SQL = """
with t as (
  select conv_id, role, text, row_number() over w as position, count(*) over (partition by conv_id) as n_turns,
    string_agg(coalesce('r' || role, '') || chr(31) || coalesce('t' || text, ''), chr(30)) over w as prefix
  from conversations
  window w as (partition by conv_id order by turn nulls first, role nulls first, text nulls first
    rows between unbounded preceding and current row)),
kept as (
  select min(conv_id) as conv_id from t where position = n_turns group by prefix
  having prefix not in (select prefix from t where position < n_turns))
select t.conv_id, t.position, t.n_turns, t.role,
  '<|im_start|>' || coalesce(t.role, 'unknown') || chr(10) || coalesce(t.text, '') || '<|im_end|>' || chr(10) as segment
from t join kept on kept.conv_id is not distinct from t.conv_id
"""

_OP9_SQL = """
with p as (select row_number() over () as r, doc_id, source, text from documents),
l as (
  select r, source, text, unnest(string_split(text, chr(10))) as line,
    unnest(range(1, len(string_split(text, chr(10))) + 1)) as at from p where text is not null),
t as (select source, count(distinct text) as total from p group by source),
b as (
  select l.source, trim(l.line, ' ') as line
  from l join t on t.source is not distinct from l.source
  where trim(l.line, ' ') <> '' group by 1, 2
  having count(distinct l.text) >= 5 and count(distinct l.text) / any_value(t.total) >= 0.02),
k as (
  select l.r, sum((b.line is not null)::int) as n_dropped,
    string_agg(l.line, chr(10) order by l.at) filter (where b.line is null) as kept
  from l left join b on b.source is not distinct from l.source and b.line = trim(l.line, ' ') group by l.r)
select p.doc_id, coalesce(k.n_dropped, 0)::bigint as n_dropped,
  case when p.text is not null then length(coalesce(k.kept, '')) end as n_chars_kept,
  case when p.text is not null then sha256(coalesce(k.kept, '')) end as kept_sha256
from p left join k on k.r = p.r
"""

QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_chat_format": op3_chat_format,
    "op4_pu_toxicity": op4_pu_toxicity,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_fm_decontamination": op6_fm_decontamination,
    "op7_repair_output": op7_repair_output,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_line_dedup": op9_line_dedup,
    "op10_simhash": op10_simhash,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_ranked_search": op12_ranked_search,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE = {
    "op3_chat_format": _OP3_SQL,
    "op5_minhash_near_dedup": _OP5_SQL,
    "op6_fm_decontamination": _OP6_SQL,
    "op9_line_dedup": _OP9_SQL,
    "op11_substring_dedup": _OP11_SQL,
    "op12_ranked_search": _OP12_SQL,
    "op13_prefix_trie": _OP13_SQL,
}
