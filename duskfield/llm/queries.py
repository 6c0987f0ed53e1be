"""The registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .importance import resample
from .line_dedup import dedup_lines
from .media import from_media, to_media
from .minhash import near_duplicates
from .mixing import mix_sources
from .packing import pack_documents
from .pii import find_personal_data, listed
from .prefix_trie import prefix_trie, sequences, with_heads
from .quality_classifier import quality_scores
from .quality_rules import host_quality
from .secret_scan import find_secrets
from .secret_scan import listed as listed_secrets
from .token_counts import count_tokens
from .url_filters import filter_urls

#: The url rules as (verdict, host, path).
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """See ``pack_documents``: per piece where it lies in its document and its sequence, and the CRC of its ids."""
    path = public_tokenizers.path
    got = pack_documents(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"))
    return got.select("doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_group")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """See ``dedup_lines``: per document the lines before, the lines dropped, and the digest of the text that stays."""
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """See ``quality_scores``."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """See ``host_quality``: counts, base rules and the verdict that the document's host has a part in."""
    got = host_quality(table(spark, sf_dir, "documents"), rates=True)
    rates = [F.round(c, 6).alias(c) for c in got.columns if c.startswith("rate_")]
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_docs", *rates, "host_bad")


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """See ``near_duplicates``."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """See ``to_media`` and ``from_media``; the feature lists the clips as first-last frame@start-end milliseconds."""
    got = from_media(to_media(table(spark, sf_dir, "documents")))
    clip = F.transform("clips", lambda c: F.concat_ws("", c["first_frame"], F.lit("-"), c["last_frame"], F.lit("@"), c["start_ms"], F.lit("-"), c["end_ms"]))
    return got.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -64, 64)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.array_join(clip, ",").alias("feature"),
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """See ``mix_sources``."""
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """See ``count_tokens``."""
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """See ``find_personal_data``: counts and digest of the base spans, and all spans."""
    got = find_personal_data(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return got.select(
        F.col("id").alias("doc_id"),
        count(0).alias("n_email"),
        count(1).alias("n_ip"),
        count(2).alias("n_card"),
        count(3).alias("n_phone"),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.concat("base", "more")).alias("spans"),
        F.size("more").cast("long").alias("n_secret"),
        (F.size("base") + F.size("more")).cast("long").alias("n_spans"),
    )


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """See ``filter_urls``."""
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """See ``find_secrets``: counts and digest of the base spans, and all spans."""
    got = find_secrets(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return got.select(
        F.col("id").alias("doc_id"),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(listed_secrets(F.col("base")), 256).alias("base_sha256"),
        listed_secrets(F.concat("base", "more")).alias("spans"),
        F.size("more").cast("long").alias("n_random"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """See ``prefix_trie``: the nodes of the conversations rebuilt with their groups' heads."""
    return prefix_trie(with_heads(sequences(table(spark, sf_dir, "conversations"))))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """See ``resample``: documents drawn towards the words of ``benchmark``."""
    got = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_features", "weight", "score", "rank")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_packing, op2_line_dedup, op3_quality_classifier, op4_quality_rules, op5_minhash, op6_media, op7_mixing, op8_token_counts, op9_pii, op10_url_filters, op11_secrets, op12_prefix_trie, op13_importance)}


_WS = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
_UP, _LOW = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

OP2_SQL = f"""
with base as (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents),
lines as (select doc_id, unnest(range(1, len(parts) + 1)) as pos, unnest(parts) as line from base),
keyed as (select doc_id, pos, line, translate(trim(line, {_WS}), {_UP}, {_LOW}) as k from lines),
common as (select k, max(doc_id) as keeper from keyed where length(k) >= 20 group by k having count(distinct doc_id) >= 3),
marked as (select keyed.doc_id, pos, line, (common.k is not null and keyed.doc_id <> keeper) as gone from keyed left join common on keyed.k = common.k)
select doc_id, count(*) as n_lines, cast(count(*) filter (where gone) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""

OP4_SQL = r"""
with base as (select doc_id, source, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
lines as (select doc_id, count(*) - count(distinct l) as n_dup_lines from (select doc_id, unnest(string_split(t, chr(10))) as l from base) where regexp_matches(l, '[^\x20\x09-\x0D]') group by doc_id),
win as (select doc_id, unnest(range(1, len(w) - 3)) as i, w from base where len(w) >= 5),
g as (select doc_id, i, hash(w[i], w[i+1], w[i+2], w[i+3], w[i+4]) as h from win),
rep as (select doc_id, i from g qualify count(*) over (partition by doc_id, h) > 1),
cov as (select doc_id, cast(sum(least(5, coalesce(nxt - i, 5))) as bigint) as n_repeat_words from (select doc_id, i, lead(i) over (partition by doc_id order by i) as nxt from rep) group by doc_id),
f as (select base.doc_id, source, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
  cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols, cast(coalesce(n_dup_lines, 0) as bigint) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words
  from base left join lines using (doc_id) left join cov using (doc_id)),
r as (select *, n_words < 10 as f1, 100 * n_repeat_words > 20 * n_words as f2, 10 * n_symbols > n_words as f3, (word_chars < 2 * n_words or word_chars > 15 * n_words) as f4, n_dup_lines >= 5 as f5 from f),
long as (select source, u.r as r, u.v as v from r, lateral (select unnest([1, 2, 3, 4, 5]) as r, unnest([f1, f2, f3, f4, f5]) as v) u),
hosts as (select source, r, count(*) * 1.0E0 as n, sum(v::int) * 1.0E0 as x from long group by source, r),
mom as (select r, sum(n) as n, count(*) as k, sum(x) / sum(n) as m, sum(x * x / n) / sum(n) as sq from hosts group by r),
pri as (select r, m, case when greatest(sq - m * m, 0) - m * (1 - m) * k / n > 1e-12 then least(greatest(m * (1 - m) / (greatest(sq - m * m, 0) - m * (1 - m) * k / n) - 1, 1), 1000) else 1000 end as s from mom),
post as (select source, r, n, m, s, (x + m * s) / (n + s) as rate from hosts join pri using (r)),
bad as (select source, cast(max(n) as bigint) as host_docs, max(rate - 2 * sqrt(rate * (1 - rate) / (n + s + 1)) - least(0.5E0, m + 2 * sqrt(m * (1 - m) / (s + 1)))) > 0 as host_bad,
  round(max(case when r = 1 then rate end), 6) as rate_short, round(max(case when r = 2 then rate end), 6) as rate_repeats, round(max(case when r = 3 then rate end), 6) as rate_symbols, round(max(case when r = 4 then rate end), 6) as rate_word_length, round(max(case when r = 5 then rate end), 6) as rate_dup_lines
  from post group by source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (f1 or f2) as base_failed,
  not (f1 or f2) and not (host_bad and (f1 or f2 or f3 or f4 or f5)) as kept, host_docs, rate_short, rate_repeats, rate_symbols, rate_word_length, rate_dup_lines, host_bad
from r join bad on r.source is not distinct from bad.source
"""

OP10_SQL = r"""
with parts as (select page_id, case when url like '%://%' then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
hp as (select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from parts),
rules as (select * from (values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')) t(verdict, rhost, rpath)),
hit as (select page_id, rhost || rpath as rule, verdict from hp join rules on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
  qualify row_number() over (partition by page_id order by length(rhost || rpath) desc, length(rhost) desc) = 1)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from hp left join hit using (page_id)
"""


# CRC-32 by its table: a list of 256 numbers, and a fold over a text's bytes.
_CRC_TABLE = "(select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t from range(256) r(i))"


def _crc(text: str) -> str:
    byte = f"16 * (instr('0123456789ABCDEF', hex({text})[2 * i + 1]) - 1) + instr('0123456789ABCDEF', hex({text})[2 * i + 2]) - 1"
    return f"xor(list_reduce(list_concat([4294967295], list_transform(range(0, strlen({text})), lambda i: {byte})), lambda c, b: xor(c >> 8, t[1 + xor(c, b) % 256])), 4294967295)"


OP12_SQL = f"""
with crc as {_CRC_TABLE},
own as (select conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} order by turn nulls first) as turns from conversations where conv_id is not null group by conv_id),
h as (select conv_id, turns, conv_id - conv_id % 100 as base, {_crc("cast(conv_id as varchar)")} % 6 as h from own, crc),
seq as (select h.conv_id, list_concat(coalesce(b.turns, [])[1:h.h], h.turns[h.h + 1:]) as turns from h left join own b on b.conv_id = h.base),
pre as (select conv_id, len(turns) as size, d, turns[1:d] as p from (select *, unnest(range(0, len(turns) + 1)) as d from seq)),
nodes as (select d, p, min(conv_id) as conv_id, count(*) as n_convs, coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where size = d), '') as ends,
  case when d > 0 then (count(*) - 1) * length(p[d].text) else 0 end as saved from pre group by d, p),
kids as (select p[1:d - 1] as p, count(*) as n from nodes where d > 0 group by all),
known as (select nodes.*, coalesce(n, 0) as n_children from nodes left join kids using (p)),
up as (select b.d, b.p, unnest(range(0, b.d + 1)) as e, n_children, saved from known b),
sub as (select e as d, p[1:e] as p, count(*) filter (where n_children = 0) as n_leaves, sum(saved) as saved_tokens from up group by all)
select a.conv_id, a.d as depth, q.conv_id as parent_conv_id, a.n_convs, a.n_children, cast(n_leaves as bigint) as n_leaves, cast(saved_tokens as bigint) as saved_tokens, sha256(a.ends) as ends_sha256
from known a join sub on sub.p = a.p and sub.d = a.d left join nodes q on q.d = a.d - 1 and q.p = a.p[1:a.d - 1]
"""

OP13_SQL = rf"""
with crc as {_CRC_TABLE},
docs as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UP}, {_LOW}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
goal as (select unnest(regexp_extract_all(translate(coalesce(text, ''), {_UP}, {_LOW}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word from benchmark),
used as (select doc_id, word, count(*) as n from (select doc_id, unnest(w) as word from docs) group by all),
target as (select word, count(*) as n from goal group by word),
vocab as (select word, {_crc("word")} % 10000 as bucket from (select word from used union select word from target), crc),
s as (select bucket, sum(n) as s from used join vocab using (word) group by bucket),
t as (select bucket, sum(n) as t from target join vocab using (word) group by bucket),
size as (select coalesce((select sum(s) from s), 0) as S_all, coalesce((select sum(t) from t), 0) as T_all),
gain as (select bucket, floor(1000 * ln(cast((coalesce(t, 0) + 1) * (S_all + 10000) as double) / cast((s + 1) * (T_all + 10000) as double))) as gain from s left join t using (bucket), size),
mean as (select doc_id, cast(floor(sum(n * gain) / sum(n)) as bigint) as weight from used join vocab using (word) join gain using (bucket) group by doc_id),
scored as (select doc_id, cast(len(w) as bigint) as n_features, coalesce(weight, 0) as weight,
  coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((cast('0x' || sha256('2024:' || doc_id)[1:8] as ubigint) + 0.5E0) / 4294967296.0E0))) as bigint) as score from docs left join mean using (doc_id)),
placed as (select doc_id, row_number() over (order by score desc, doc_id) as place, 10 * count(*) over () // 100 as drawn from scored where n_features >= 20)
select doc_id, n_features, weight, score, case when place <= drawn then place end as rank from scored left join placed using (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": OP2_SQL, "op4_quality_rules": OP4_SQL, "op10_url_filters": OP10_SQL, "op12_prefix_trie": OP12_SQL, "op13_importance": OP13_SQL}
