"""The operators over their whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, fingerprints, license_scan, line_dedup, near_dedup, phrases, pii, piece_encoding, simhash, spelling, token_files, toxicity, warc
from tidemark.llm.common import table
from tidemark.session import shared_dir

QUERIES: dict = {}
ORACLE: dict = {}


def base32_sql(digest: str) -> str:
    """SQL of the base32 form of a 40-digit hexadecimal text: each five digits give four characters."""
    value = "('0x' || substr({d}, {start}, 5))::bigint"
    sign = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(({v} >> {shift}) & 31 as integer) + 1, 1)"
    values = [value.format(d=digest, start=5 * i + 1) for i in range(8)]
    return " || ".join(sign.format(v=v, shift=s) for v in values for s in (15, 10, 5, 0))


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op6_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    done = piece_encoding.encode_documents(table(spark, sf_dir, "documents"), path)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    token_files.write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path, end=2)
    return token_files.read_ids(spark, path)


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def held_out(key: str = "doc_id"):
    """Rows whose labels are not learnt from."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").filter(~held_out()))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that lost lines or kept all, with the text left."""
    return line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fingerprints.with_edits(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.printed(F.col("anchors")).alias("fingerprint"),
        fingerprints.printed(F.col("edited_anchors")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
        fingerprints.likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"),
    )


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.train(docs))
    base = F.filter("found", lambda s: s.base)
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    count = lambda kind: F.size(F.filter(base, lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in pii.KINDS], F.sha2(written(base), 256).alias("base_sha256"), written(F.col("found")).alias("spans"))


@query
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.similar(table(spark, sf_dir, "documents"), percent=85)


@query
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.phrases(table(spark, sf_dir, "documents"))


@query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@query
def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.similar(table(spark, sf_dir, "documents"))


ORACLE["op9_warc"] = f"""
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, html, sha1(html) as h, max(page_id) over (partition by html) as top from p)
select page_id, cast(strlen(html) as bigint) as payload_bytes, {base32_sql('h')} as payload_digest,
  case when page_id = top then 'response' else 'revisit' end as record_type,
  case when page_id < top then top end as refers_to
from d"""

ORACLE["op11_phrases"] = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
places as (select lang, w, unnest(range(1, len(w) + 1)) as i from w),
f1 as (select lang, w[i] as w1, count(*) as f from places group by all),
f2 as (select lang, w[i] as w1, w[i + 1] as w2, count(*) as f from places where i < len(w) group by all),
f3 as (select lang, w[i] as w1, w[i + 1] as w2, w[i + 2] as w3, count(*) as f from places where i + 1 < len(w) group by all having count(*) >= 10),
n as (select lang, cast(sum(f) as bigint) as n from f1 group by lang),
longer as (select lang, w1, w2, max(f) as f from (
  select lang, w1, w2, f from f3 union all select lang, w2, w3, f from f3) group by all),
two as (
  select f2.lang, f2.w1 || ' ' || f2.w2 as phrase, f2.f as a, x.f as l, y.f as r, 1 as k
  from f2 join f1 x on x.lang = f2.lang and x.w1 = f2.w1 join f1 y on y.lang = f2.lang and y.w1 = f2.w2
  left join longer on longer.lang = f2.lang and longer.w1 = f2.w1 and longer.w2 = f2.w2
  where f2.f >= 10 and 100 * coalesce(longer.f, 0) < 50 * f2.f),
three as (
  select f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3 as phrase, f3.f as a, x.f as l, y.f as r, 1 as k
  from f3 join f1 x on x.lang = f3.lang and x.w1 = f3.w1 join f2 y on y.lang = f3.lang and y.w1 = f3.w2 and y.w2 = f3.w3
  union all
  select f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.f, x.f, y.f, 2
  from f3 join f2 x on x.lang = f3.lang and x.w1 = f3.w1 and x.w2 = f3.w2 join f1 y on y.lang = f3.lang and y.w1 = f3.w3),
cuts as (
  select *, cast(cast(1000000 as hugeint) * a * a // (cast(l as hugeint) * r) as bigint) as score
  from (select * from two union all select * from three)),
lowest as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from lowest)
select lang, rank, phrase, a, l, r, n, score from ranked join n using (lang) where rank <= 2000"""

#: What lower-cases A-Z alone, behind a text in ``translate``.
UPPER_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLE["op2_near_dedup"] = rf"""
with recursive
w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), {UPPER_LOWER}), '[^\x20\x09-\x0D]+') as w
  from documents),
grams as (
  select doc_id, case when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end as s
  from w where len(w) > 0),
sets as materialized (
  select doc_id, len(s) as n, array_to_string(s, chr(10)) as s from (select doc_id, list_sort(list_distinct(s)) as s from grams)),
alike as materialized (select min(doc_id) as u, s, n from sets group by s, n),
every as (select u, n, unnest(string_split(s, chr(10))) as g from alike),
shared as (select g, row_number() over () as id from every group by g having count(*) > 1),
x as (select u, n, id as g from every join shared using (g)),
links as (
  select a.u as a, b.u as b from x a join x b on a.g = b.g and a.u < b.u
  where 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  group by a.u, b.u, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
ways as (select a, b from links union all select b, a from links),
reach as (
  select u as node, u as seen from alike
  union
  select r.node, v.b from reach r join ways v on v.a = r.seen),
lowest as (select node, min(seen) as component from reach group by node)
select d.doc_id, cast(coalesce(s.n, 0) as bigint) as n_shingles, coalesce(l.component, d.doc_id) as component_id,
  coalesce(l.component, d.doc_id) = d.doc_id as kept
from documents d left join sets s on s.doc_id = d.doc_id left join alike on alike.s = s.s left join lowest l on l.node = alike.u"""


def crc32_sql(text: str) -> str:
    """SQL of the crc32 of a text of code points below 2048, four bits at a time."""
    steps = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ (value & 1) * 0xEDB88320
        steps.append(value)
    octets = f"flatten(list_transform(string_split({text}, ''), lambda c: case when ord(c) < 128 then [ord(c)] else [192 + (ord(c) >> 6), 128 + (ord(c) & 63)] end))"
    halves = f"flatten(list_transform({octets}, lambda o: [o & 15, o >> 4]))"
    step = f"lambda c, o: xor(c >> 4, ({steps}::bigint[])[xor(c & 15, o) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {halves}::bigint[]), {step}), 4294967295::bigint)"


ORACLE["op12_spelling"] = rf"""
with recursive
runs as (
  select doc_id, unnest(regexp_extract_all(translate(text, {UPPER_LOWER}), '[a-zÀ-ÿ]+')) as run
  from documents),
met as (select doc_id, run, count(*) as n from runs group by doc_id, run),
hashed as (select run, n, {crc32_sql("doc_id || ':' || run")} as h from met),
written as (
  select n, case when h % 199 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word
  from hashed),
words as (
  select word, cast(sum(n) as bigint) as n from written where length(word) >= 6 group by word having sum(n) >= 5),
cuts as (
  select word, i, substr(word, 1, i - 1) || substr(word, i + 1) as cut
  from (select word, unnest(range(1, length(word) + 1)) as i from words)),
near as (
  select a.word as a, b.word as b from cuts a join cuts b on a.cut = b.cut and a.i = b.i and a.word <> b.word
  union select cuts.word, words.word from cuts join words on words.word = cuts.cut
  union select words.word, cuts.word from cuts join words on words.word = cuts.cut),
ranked as (
  select a as word, b as form, w.n as form_n, count(*) over (partition by a) as n_near,
    row_number() over (partition by a order by w.n desc, b) as rank
  from near join words w on w.word = near.b),
formed as (
  select words.word, words.n, coalesce(n_near, 0) as n_near, case when form_n >= 5 * words.n then form end as form,
    case when form_n >= 5 * words.n then form_n end as form_n
  from words left join ranked on ranked.word = words.word and rank = 1),
follow as (
  select word, word as root, form as next from formed
  union all
  select f.word, f.next, o.form from follow f join formed o on o.word = f.next where f.next is not null)
select formed.word, formed.form, root, n, n_near, form_n
from formed join follow on follow.word = formed.word and follow.next is null"""


def xxh64_sql(text: str, source: str, seed: int = 42) -> str:
    """CTEs that end in ``hashed``: each distinct ``text`` of ``source`` as ``g`` with its XXH64 ``h`` as ubigint."""
    # the five odd factors of XXH64, fixed values
    p1, p2, p3, p4, p5 = (
        f"{p}::uhugeint" for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
    )
    full = 1 << 64
    low = lambda e: f"(({e}) & {full - 1}::uhugeint)"
    bound = lambda e, use: f"list_transform([{e}], lambda v: {use})[1]"
    rotated = lambda e, n: bound(e, low(f"(v << {n}) | (v >> {64 - n})"))
    folded = lambda e, n: bound(e, f"xor(v, v >> {n})")
    number = lambda at, size: "('0x' || " + " || ".join(f"substr(hx, 2 * ({at}) + {2 * i + 1}, 2)" for i in reversed(range(size))) + ")::ubigint::uhugeint"
    mixed = lambda a, x: low(f"{rotated(low(f'{a} + {x} * {p2}'), 31)} * {p1}")
    over = lambda start, items, step: f"list_reduce(list_prepend({start}, {items}), lambda a, x: {step})"
    begin = [low(f"{seed}::uhugeint + {p1} + {p2}"), low(f"{seed}::uhugeint + {p2}"), f"{seed}::uhugeint", low(f"{full + seed}::uhugeint - {p1}")]
    stripes = [over(b, f"list_transform(range(n // 32), lambda s: {number(f'32 * s + {8 * k}', 8)})", mixed("a", "x")) for k, b in enumerate(begin)]
    merged = low(" + ".join(rotated(f"v{k}", n) for k, n in enumerate((1, 7, 12, 18))))
    for k in range(4):
        merged = low(f"xor({merged}, {mixed('0::uhugeint', f'v{k}')}) * {p1} + {p4}")
    eights = f"list_transform(range(n % 32 // 8), lambda j: {number('n // 32 * 32 + 8 * j', 8)})"
    step = low(f"{rotated(f'xor(a, {mixed("0::uhugeint", "x")})', 27)} * {p1} + {p4}")
    four = low(f"{rotated(f'xor(h, {low(number("n // 8 * 8", 4) + f" * {p1}")})', 23)} * {p2} + {p3}")
    ones = f"list_transform(range(n % 4), lambda j: {number('n // 4 * 4 + j', 1)})"
    one = low(f"{rotated(f'xor(a, {low(f"x * {p5}")})', 11)} * {p1}")
    last = folded(low(f"{folded(low(f'{folded("h", 33)} * {p2}'), 29)} * {p3}"), 32)
    return f"""
h0 as (select g, hex(g) as hx, strlen(g) as n from (select distinct {text} as g from {source})),
h1 as (select *, {', '.join(f'{s} as v{k}' for k, s in enumerate(stripes))} from h0),
h2 as (select g, hx, n, {low(f"n::uhugeint + case when n >= 32 then {merged} else {seed}::uhugeint + {p5} end")} as h from h1),
h3 as (select g, hx, n, {over('h', eights, step)} as h from h2),
h4 as (select g, hx, n, case when n % 8 >= 4 then {four} else h end as h from h3),
h5 as (select g, {over('h', ones, one)} as h from h4),
hashed as (select g, ({last})::ubigint as h from h5)"""


ORACLE["op13_simhash"] = rf"""
with recursive
w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), {UPPER_LOWER}), '[^\x20\x09-\x0D]+') as w
  from documents),
grams as (
  select doc_id, unnest(case when len(w) < 4 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as g
  from w where len(w) > 0),
{xxh64_sql('g', 'grams')},
votes as (select doc_id, {' + '.join(f'case when 2 * sum((h >> {b}) & 1) > count(*) then {1 << b}::ubigint else 0::ubigint end' for b in range(64))} as f
  from grams join hashed using (g) group by doc_id),
prints as materialized (select d.doc_id, coalesce(f, 0::ubigint) as f from documents d left join votes v on v.doc_id = d.doc_id),
alike as (select f, min(doc_id) as u from prints group by f),
ways as (select a.u as a, b.u as b from alike a join alike b on a.f <> b.f and bit_count(xor(a.f, b.f)) <= 4),
reach as (
  select u as node, u as seen from alike
  union
  select r.node, v.b from reach r join ways v on v.a = r.seen),
lowest as (select node, min(seen) as component_id from reach group by node)
select doc_id, lpad(lower(hex(f)), 16, '0') as fingerprint, component_id
from prints join alike using (f) join lowest on node = u"""

ORACLE["op8_line_dedup"] = rf"""
with lines as (
  select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as line_no
  from documents where text is not null),
placed as materialized (
  select *, row_number() over (order by doc_id, line_no) as place, array_to_string(w, ' ') as k
  from (select *, regexp_extract_all(lower(line), '[^\x09-\x0D\x1C-\x20\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+') as w from lines)),
earliest as materialized (select k, string_split(k, ' ') as w, min(place) as place from placed where k <> '' group by k),
-- an edit leaves the first or the last half of the shorter line, of m words, as it is
sized as (select place, w, unnest([len(w), len(w) - 1]) as m from earliest where len(w) >= {line_dedup.LEAST_WORDS}),
halves as (
  select place, w, m, 1 as side, array_to_string(w[:m // 2], ' ') as half from sized
  union all select place, w, m, 2, array_to_string(w[len(w) - (m - m // 2) + 1:], ' ') from sized),
pairs as (
  select distinct a.place as a, b.place as b, a.w as s, b.w as l from halves a join halves b using (m, side, half)
  where len(a.w) = m and a.place <> b.place and m >= {line_dedup.LEAST_WORDS}),
compared as (
  select a, b, s, l, coalesce(list_min(list_filter(range(1, len(s) + 1), lambda i: s[i] <> l[i])), len(s) + 1) as f
  from pairs),
near as (select a, b from compared where s[f + len(s) - len(l) + 1:] = l[f + 1:]),
edited as (select a as place from near where b < a union select b from near where a < b),
judged as (
  select p.*, e.place is not null and (p.place > e.place or e.place in (select place from edited)) as gone
  from placed p left join earliest e on e.k = p.k),
left_over as (
  select doc_id, coalesce(string_agg(line, chr(10) order by line_no) filter (not gone), '') as text, count(*) as n_lines,
    count(*) filter (gone) as n_dropped
  from judged group by doc_id)
select d.doc_id, l.text, coalesce(l.n_lines, 0) as n_lines, coalesce(l.n_dropped, 0) as n_dropped
from documents d left join left_over l on l.doc_id = d.doc_id"""
