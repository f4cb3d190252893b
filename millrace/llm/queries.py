"""Driver queries of the operators in this subpackage and SQL that repeats them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import chat, decontam, licences, mixing, neardup, resample, sharding, structure, tokens, topk, toxicity, warc, wavelet

SEED = 20260818


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(_table(spark, sf_dir, "documents"), n_shards=40, seed=SEED)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(_table(spark, sf_dir, "documents"), seed=SEED, weights=(3, 1, 2), budget=(3, 2), max_epochs=2)


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), is_query=F.col("vec_id") % 100 == 0, k=10)


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents have no paths; source, language and id make one."""
    path = F.concat_ws("/", "source", "lang", "doc_id")
    return licences.scan(_table(spark, sf_dir, "documents"), path)


def op3_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(_table(spark, sf_dir, "documents"), tokenizer="word_bpe_49k.json", limit=2048)


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(_table(spark, sf_dir, "conversations"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents"), toxicity.with_kinds(_table(spark, sf_dir, "labels")), toxicity.KINDS)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"), min_revisit_bytes=0).drop("archive", "record_offset")


def op9_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.scan(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=10)


def op10_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(_table(spark, sf_dir, "documents"), size=4, percent=80)


def op11_tokenids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.round_trip(_table(spark, sf_dir, "documents"), tokenizer="word_bpe_49k.json", end_id=1)


def op12_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.digests(*structure.damaged(_table(spark, sf_dir, "conversations")))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), percent=10, min_words=20, most_words=1, buckets=10_000, seed=2024)


QUERIES = {f.__name__: f for f in (op1_topk, op2_licences, op3_tokens, op4_sharding, op5_chat, op6_toxicity, op7_warc, op8_mixing, op9_decontam, op10_neardup, op11_tokenids, op12_structure, op13_resample)}

_OP8 = f"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size,
         md5('{SEED}:' || coalesce('=' || doc_id::varchar, '') || ':' || coalesce('=' || md5(text), '')) as k from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
r as (select *, [3, 1, 2][((row_number() over (order by source is null, source) - 1) % 3 + 1)::int]::bigint as weight,
             row_number() over (order by source is null, source) as rk from s),
f as (select *, sum(source_size) over ()::bigint as total,
             (sum(weight) over () - coalesce(sum(weight) over a, 0))::bigint as left_weight,
             (total * 3 - coalesce(sum(source_size) over a, 0) * 4)::bigint as remaining
      from r window a as (order by source_size / weight, rk rows between unbounded preceding and 1 preceding)),
o as (select *, (source_size::hugeint * 4 * left_weight > remaining::hugeint * weight) as above from f),
p as (select *, bool_or(above) over (order by source_size / weight, rk rows between unbounded preceding and current row) as is_open from o),
b as (select arg_max(remaining, left_weight) as l, max(left_weight) as lw from p where is_open),
t as (select source, source_size,
             case when is_open then l::double / 2.0::double * weight::double / lw::double else source_size::double * 2.0::double end as target
      from p left join b on true),
c as (select d.*, t.source_size, t.target,
             case when t.source_size > 0 then floor(t.target / t.source_size)::bigint else 0 end as whole,
             sum(size) over (partition by d.source order by k rows between unbounded preceding and current row) as cum
      from d join t on d.source is not distinct from t.source),
select doc_id, size, source_size, target,
       (size * (whole + case when cum * 2 - size <= (target - whole * source_size) * 2 then 1 else 0 end))::bigint as taken from c
"""

_OP1 = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as v from embeddings
           where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
      from v q, v c where q.vec_id % 100 = 0 and c.vec_id <> q.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from p)
select query_id, rank, vec_id, score from r where rank <= 10
"""

def _feistel(given: str) -> str:
    """Select x, y of the rows in ``given`` (x, y), y moved by one pass through the network on a x b cells."""
    mixed = lambda half, k: f"(((({half} + {k}) % {sharding.PRIME}) * (({half} + {k}) % {sharding.PRIME})) % {sharding.PRIME} * {sharding.MULTIPLIER} + {k}) % {sharding.PRIME}"
    step = f"(select x, y % a as l, y // a as r, a, b from ({given}), side)"
    for i, k in enumerate(sharding.round_keys(SEED)):
        moved = f"(l + {mixed('r', k)}) % a as l, r" if i % 2 == 0 else f"l, (r + {mixed('l', k)}) % b as r"
        step = f"(select x, {moved}, a, b from {step})"
    return f"select x, l + a * r as y from {step}"


# CRC-32 by table, a byte at a time; the table follows from the reflected polynomial
_OP4 = f"""
with recursive bits as (select i, 0 as k, i as v from range(256) t(i) union all
    select i, k + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from bits where k < 8),
tab as (select list(v order by i) as tab from bits where k = 8),
d as (select doc_id, (strlen(coalesce(text, '')) + 16)::bigint as size, xor(list_reduce(list_transform(pairs,
        lambda x: ('0x' || x)::bigint), lambda c, x: xor(c >> 8, tab[1 + (xor(c, x) & 255)]), 4294967295::bigint), 4294967295) as text_crc32
      from (select *, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') as pairs from documents), tab),
total as (select count(*) as n, greatest({sharding.MIN_BUCKETS}, ceil(count(*) / {sharding.BUCKET_ROWS}))::bigint as buckets from d),
side as (select n, floor(sqrt(n - 1))::bigint + 1 as a, ceil(n / (floor(sqrt(n - 1)) + 1))::bigint as b from total),
numbered as (select d.*, row_number() over (order by ((((coalesce(doc_id, 0) % {sharding.PRIME} + {sharding.PRIME}) % {sharding.PRIME} + text_crc32) % {sharding.PRIME}) * {sharding.MULTIPLIER}) % {sharding.PRIME} % buckets,
    doc_id nulls first, size, text_crc32) - 1 as x from d, total),
walk as (select x, y, 1 as steps from ({_feistel("select x, x as y from numbered")}) union all
    select x, y, steps from (select x, y, 0 as steps from ({_feistel("select x, y from walk, side where y >= n")}))),
placed as (select x, y from walk, side where y < n)
select doc_id, size, text_crc32, 'rows' as law, (y % 40)::int as shard, (y // 40)::bigint as slot, null::int as grown_shard, y as "position" from numbered join placed using (x)
"""

# base 32: five bits a sign, from the digest's hexadecimal digits
_OP7 = """
with p as (select page_id, coalesce(html, '') as h from pages),
d as (select page_id, strlen(h)::bigint as payload_bytes, sha1(h) as x from p),
b as (select *, array_to_string(list_transform(range(1, 41), lambda i: substr('0000000100100011010001010110011110001001101010111100110111101111',
                (strpos('0123456789abcdef', substr(x, i::int, 1)) * 4 - 3)::int, 4)), '') as bits from d),
e as (select *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + list_sum(list_transform(range(0, 5), lambda j: substr(bits, (1 + 5 * i + j)::int, 1)::int * (1 << (4 - j)::int)))::int, 1)), '') as payload_digest,
             max(page_id) over (partition by x, payload_bytes) as newest from b)
select page_id, payload_bytes, payload_digest, case when newest is null or page_id = newest then 'response' else 'revisit' end as record_type,
       case when page_id is null or page_id < newest then newest end as refers_to from e
"""

_BENCH_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OP9 = f"""
with i as (select item_id, regexp_extract_all({_ASCII_LOWER}, '{_BENCH_WORD}') as w from benchmark),
n as (select item_id, w, least(10, len(w)) as size from i where len(w) > 0),
g as (select distinct item_id, size, array_to_string(w[k:k + size - 1], ' ') as gram from (select *, unnest(range(1, len(w) - size + 2)) as k from n)),
d as (select row_number() over () as r, doc_id, regexp_extract_all({_ASCII_LOWER}, '{_BENCH_WORD}') as w from documents),
h as (select r, k, size, item_id from (select r, size, k, array_to_string(w[k:k + size - 1], ' ') as gram
        from (select r, w, size, unnest(range(1, len(w) - size + 2)) as k from d, (select distinct size from g) where len(w) >= size)) join g using (size, gram)),
c as (select r, count(distinct place) as n_hit from (select r, unnest(range(k, k + size)) as place from h) group by r),
t as (select r, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids from h group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join c using (r) left join t using (r)
"""

_OP10 = f"""
with recursive d as (select doc_id, regexp_extract_all({_ASCII_LOWER}, '[^\\x20\\x09-\\x0D]+') as w from documents),
s as (select distinct doc_id, hash(array_to_string(w[k:k + 3], ' '), least(len(w), 4)) as x from (select *, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as k from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as inter from s a join s b on a.x = b.x and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * inter >= 80 * (x.n + y.n - inter)),
e as (select a, b from l union select b, a from l),
r as (select doc_id as node, doc_id as reached from d union select r.node, e.b from r join e on r.reached = e.a),
c as (select node, min(reached) as component_id from r group by node)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, doc_id = component_id as kept
from d left join n using (doc_id) join c on c.node = doc_id
"""

def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _edit(state: str, cost: str, letter: str, piece: str | None = None) -> str:
    """The (cost, audit, text) of a state after one more edit; null stays null."""
    text = f"{state}.t || chr(10) || {piece}" if piece else f"{state}.t"
    return f"case when {state} is not null then {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {text}}} end"


def _stay(state: str, role: int) -> str:
    """Keep or rerole a row as user (2) or assistant (3)."""
    kept = _edit(state, "extra", "K", "(role || ':' || text)")
    moved = _edit(state, "1 + extra", "R", f"('{structure.NAMES[role]}:' || text)")
    return f"case when fault in (1, 2) then null when kind = {role} then {kept} else {moved} end"


def _inserted(source: str) -> str:
    """n0 to n3 of ``source`` become s0 to s3: empty user and assistant turns may come next."""
    user, assistant = (lambda s: _edit(s, "5", "I", "'user:'")), (lambda s: _edit(s, "5", "I", "'assistant:'"))
    return f"""(select * exclude (n0, n1, n2, n3, y2), n0 as s0, n1 as s1, {_least("y2", user("n3"))} as s2, {_least("n3", assistant("y2"))} as s3
      from (select *, {_least("n2", user("n0"), user("n1"))} as y2 from {source}))"""


# least (cost, audit) of each state after each row, forwards; that is enough, since letters decide cost and state
_OP12 = f"""
with recursive bits as (select i, 0 as k, i as v from range(256) t(i) union all
    select i, k + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from bits where k < 8),
tab as (select list(v order by i) as tab from bits where k = 8),
r as (select conv_id, dense_rank() over (order by conv_id nulls first) as q, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        hex(encode(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))) as k from conversations),
g as (select r.*, xor(list_reduce(list_transform(regexp_extract_all(k, '..'), lambda x: ('0x' || x)::bigint), lambda c, x: xor(c >> 8, tab[1 + (xor(c, x) & 255)]), 4294967295::bigint), 4294967295) % 20 as d from r, tab),
e as (select q, turn, case when d = 4 then 'user' else role end as role, case d when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
        unnest(range(case d when 0 then 0 when 3 then 2 else 1 end)) as copy from g),
o as (select *, row_number() over (partition by q order by turn nulls first, role, text, copy) as i from e),
p as (select *, row_number() over (partition by q, role, text order by i) > 1 as again,
        case left(role, 1) when 's' then 1 when 'u' then 2 when 'a' then 3 else 0 end as kind from o),
f as (select *, case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 1 when again then 2 when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') then 3 else 0 end as fault,
        lag(kind) over (partition by q order by i) as was from p),
c as (select q, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps, count(*) filter (where fault = 1) as blank, count(*) filter (where fault = 2) as duplicate,
        count(*) filter (where fault = 3) as truncated, count(*) filter (where was is not null and (was, kind) not in ((1, 2), (2, 3), (3, 2))) as illegal from f group by q),
w as (select q, 0::bigint as i, s0, s1, s2, s3 from {_inserted("""(select distinct q, {'c': 0::bigint, 'a': '', 't': ''} as n0, null::struct(c bigint, a varchar, t varchar) as n1,
        null::struct(c bigint, a varchar, t varchar) as n2, null::struct(c bigint, a varchar, t varchar) as n3 from r)""")} union all
    select q, i, s0, s1, s2, s3 from {_inserted(f"""(select q, i, {_edit("s0", "2", "D")} as n0,
        {_least(_edit("s1", "2", "D"), f"case when fault not in (1, 2) and kind = 1 then {_edit('s0', 'extra', 'K', chr(40) + 'role || chr(58) || text)')} end")} as n1,
        {_least(_edit("s2", "2", "D"), _stay("s0", 2), _stay("s1", 2), _stay("s3", 2))} as n2, {_least(_edit("s3", "2", "D"), _stay("s2", 3))} as n3
      from (select w.q, f.i, s0, s1, s2, s3, role, text, kind, fault, case when fault = 3 then 5 else 0 end::bigint as extra from w join f on f.q = w.q and f.i = w.i + 1))""")}),
b as (select q, arg_max({_least("s0", "s3")}, i) as x from w group by q)
select conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
       x.c as cost, x.a as audit, sha256(substr(x.t, 2)) as repaired_sha256
from (select distinct conv_id, q from r) join b using (q) left join c using (q)
"""

# checksums by table as above, of distinct words only
_OP13 = f"""
with recursive bits as (select i, 0 as k, i as v from range(256) t(i) union all
    select i, k + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from bits where k < 8),
tab as (select list(v order by i) as tab from bits where k = 8),
d as (select row_number() over () as r, doc_id, regexp_extract_all({_ASCII_LOWER}, '{_BENCH_WORD}') as w from documents),
dw as (select r, unnest(w) as word from d),
bw as (select unnest(regexp_extract_all({_ASCII_LOWER}, '{_BENCH_WORD}')) as word from benchmark),
v as (select word, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(word)), '..'), lambda x: ('0x' || x)::bigint), lambda c, x: xor(c >> 8, tab[1 + (xor(c, x) & 255)]), 4294967295::bigint), 4294967295) % 10000 as b
      from (select word from dw union select word from bw), tab),
s as (select b, count(*) as n from dw join v using (word) group by b),
t as (select b, count(*) as n from bw join v using (word) group by b),
g as (select i as b, floor(1000 * ln((coalesce(t.n, 0) + 1)::double * (select count(*) + 10000 from dw)::double
        / ((coalesce(s.n, 0) + 1)::double * (select count(*) + 10000 from bw)::double)))::bigint as gain
      from range(10000) q(i) left join s on s.b = i left join t on t.b = i),
m as (select r, floor(sum(gain)::double / count(*))::bigint as weight from dw join v using (word) join g using (b) group by r),
x as (select r, doc_id, len(w)::bigint as n_features, coalesce(weight, 0)::bigint as weight, ('0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint as h from d left join m using (r)),
y as (select *, (weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double))))::bigint as score from x),
z as (select *, row_number() over (partition by n_features >= 20 order by score desc, doc_id nulls last, n_features, weight) as place, count(*) over (partition by n_features >= 20) as able from y)
select doc_id, n_features, weight, score, case when n_features >= 20 and place <= 10 * able // 100 then place end as rank from z
"""

ORACLES = {"op1_topk": _OP1, "op4_sharding": _OP4, "op7_warc": _OP7, "op8_mixing": _OP8, "op9_decontam": _OP9, "op10_neardup": _OP10, "op12_structure": _OP12, "op13_resample": _OP13}
