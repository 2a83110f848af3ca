"""DuckDB statements for the queries that SQL can express, written from the
contracts: plain sorting, windows and unnested words in place of the operators'
histograms, lambdas and index."""

from __future__ import annotations

from crashlake.llm import op6_url_filter as url
from crashlake.llm import op7_rules as rules

WORD = "[^\\x20\\x09-\\x0D]+"


def topk() -> str:
    return """
with v as (
  select vec_id, generate_subscripts(embedding, 1) as d, unnest(embedding) as x from embeddings
), fit as (
  select vec_id from v group by vec_id having bool_and(x is not null and isfinite(x))
), w as (
  select vec_id, d, cast(floor(1024 * cast(x as double)) as bigint) as x from v join fit using (vec_id)
), s as (
  select q.vec_id as query_id, c.vec_id, cast(sum(q.x * c.x) as bigint) as score
  from w q join w c on q.d = c.d and q.vec_id <> c.vec_id where q.vec_id % 100 = 0 group by 1, 2
), r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 10"""


def url_filter() -> str:
    fits = []
    for verdict, host, path in url.RULES:
        fits.append(f"select '{host}{path}' as rule, '{verdict}' as verdict, '{host}' as h, '{path}' as p, {len(host + path)} as n")
    steps = []
    for k in range(1, url.ROUNDS + 1):
        steps.append(f"""r{k} as (select kind, host, cast(sum(rank) as bigint) as rank from (
  select r.kind, e.dst as host, cast(floor({url.DAMPING} * (r.rank * e.share)) as bigint) as rank from r{k - 1} r join steps e on r.kind = e.kind and r.host = e.src
  union all select kind, host, cast(floor((1 - cast({url.DAMPING} as double)) * rank) as bigint) from r0) group by kind, host)""")
    link = "(?i)\\bhref\\s*=\\s*[\"'']?\\s*(?:[a-z][a-z0-9+.\\-]*:)?//([^/?#\"''\\s>]+)"
    return f"""
with page as (
  select page_id, html, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path from pages
), rules as ({' union all '.join(fits)}
), fit as (
  select p.page_id, p.host, p.path, p.html, r.rule, r.verdict,
    row_number() over (partition by p.page_id order by r.n desc) as k
  from page p left join rules r on (p.host = r.h or ends_with(p.host, '.' || r.h)) and starts_with(p.path, r.p)
), one as (select * from fit where k = 1
), links as (
  select host as src, lower(unnest(regexp_extract_all(coalesce(html, ''), '{link}', 1))) as dst from one where host <> ''
), found as (select src, dst, count(*) as weight from links where src <> dst group by 1, 2
), names as (select host from one where host <> '' union select dst from found
), cut as (select distinct string_split(host, '.') as l from names
), levels as (select l, unnest(range(1, len(l) - 1)) as i from cut
), tree as (select distinct array_to_string(l[i:len(l)], '.') as child, array_to_string(l[i + 1:len(l)], '.') as parent from levels
), edges as (
  select src, dst, sum(weight) as weight from (
    select * from found union all select child, parent, 1 from tree union all select parent, child, 1 from tree) group by 1, 2
), ways as (select 0 as kind, src, dst, weight from edges union all select 1, dst, src, weight from edges
), steps as materialized (select kind, src, dst, cast(weight as double) / cast(sum(weight) over (partition by kind, src) as double) as share from ways
), given as (
  select case verdict when 'allow' then 0 else 1 end as kind, host, count(*) as n from one where rule is not null group by 1, 2
), r0 as materialized (select kind, host, cast(floor(({url.UNIT} * greatest({url.SEEDS}, sum(n) over ()))::double * (cast(n as double) / cast(sum(n) over (partition by kind) as double))) as bigint) as rank from given
), {', '.join(steps)}
, known as (
  select host, cast(coalesce(sum(rank) filter (where kind = 0), 0) as bigint) as trust, cast(coalesce(sum(rank) filter (where kind = 1), 0) as bigint) as distrust
  from r{url.ROUNDS} group by host
)
select o.page_id, o.host, o.path, o.rule,
  coalesce(o.verdict, case when coalesce(k.distrust, 0) > {url.THRESHOLD} * coalesce(k.trust, 0) then 'block' else 'allow' end) as verdict, k.trust, k.distrust
from one o left join known k on o.host = k.host"""


def quality_rules() -> str:
    p = range(rules.P)
    pairs = [(i, j) for i in p for j in range(i + 1)]
    same = " and ".join(f"a.{c} is not distinct from b.{c}" for c in rules.GROUP)
    keys, each = "level, lang, source", "level, lang, source, start"
    floors = [f * rules.UNIT for f in rules.FLOORS]
    names = ["n", *(f"s{i}" for i in p), *(f"s{i}{j}" for i, j in pairs)]
    sums = ", ".join(["count(*) as n"] + [f"sum(g{i}) as s{i}" for i in p] + [f"sum(g{i} * g{j}) as s{i}{j}" for i, j in pairs])

    def factor(k: str, source: str, by: str, consistent: float) -> str:
        """Mean and Cholesky factor e<k> from the sums in ``source``."""
        cov = ", ".join([f"s{i} / n as m{i}" for i in p] + [
            f"{consistent}::double * (s{i}{j} / n - s{i} / n * (s{j} / n)) + {floors[i] ** 2 if i == j else 0.0}::double as a{i}{j}" for i, j in pairs])
        out, layer = f"c{k} as (select {by}, {cov} from {source})", f"c{k}"
        for i, j in pairs:
            less = "(0.0::double" + "".join(f" + l{i}{t} * l{j}{t}" for t in range(j)) + ")"
            value = f"sqrt(a{i}{i} - {less})" if i == j else f"(a{i}{j} - {less}) / l{j}{j}"
            out += f", f{k}_{i}{j} as (select *, {value} as l{i}{j} from {layer})"
            layer = f"f{k}_{i}{j}"
        kept = ", ".join([f"m{i}" for i in p] + [f"l{i}{j}" for i, j in pairs])
        return out + f", e{k} as materialized (select {by}, {kept} from {layer})"

    def half(k: str) -> str:
        """The estimate e<k> of the nearer half, by the distances d<k>."""
        parts = ", ".join(f"cast(coalesce(sum({c}) filter (where rest >= n), 0) as double) + coalesce(max({c} * (rest::double / n::double)) filter (where rest < n), 0.0) as {c}" for c in names)
        return f"""b{k} as (select {each}, cast(floor({rules.BINS} * ln(1 + d2)) as bigint) as bin, {sums} from d{k} group by {each}, bin
), w{k} as (select *, sum(n) over (partition by {each}) as whole, coalesce(sum(n) over (partition by {each} order by bin rows between unbounded preceding and 1 preceding), 0) as before from b{k}
), r{k} as (select *, least((whole + {rules.P + 1}) // 2, whole) - before as rest from w{k}
), t{k} as (select {each}, {parts} from r{k} where rest > 0 group by {each}), {factor(k, f't{k}', each, rules.CONSISTENT)}"""

    def distances(k: str, rows: str, estimate: str, on: str, hide: str) -> str:
        out, layer = "", f"y{k}"
        for i in p:
            rest = "(0.0::double" + "".join(f" + l{i}{t} * y{t}" for t in range(i)) + ")"
            out += f", y{k}_{i} as (select *, (g{i} - m{i} - {rest}) / l{i}{i} as y{i} from {layer})"
            layer = f"y{k}_{i}"
        total = "0.0::double" + "".join(f" + y{i} * y{i}" for i in p)
        return f"""y{k} as (select a.*, b.* exclude ({hide}) from {rows} a left join {estimate} b on {on}){out}, d{k} as (select *, {total} as d2 from {layer})"""

    first = " + ".join(f"pow((g{i} - m{i}) / greatest(1.4826::double * q{i}, {floors[i]}::double), 2)" for i in p)
    steps = ", ".join(f"{distances(str(k), 'good', f'e{k - 1}', same, keys)}, {half(str(k))}" for k in range(1, rules.STEPS + 1))
    begin = " union all ".join(f"select {keys}, {k} as start, count(*) as texts, {', '.join(f'quantile_disc(g{i}, {start[i]}) as m{i}' for i in p)} from good group by {keys}" for k, start in enumerate(rules.STARTS))
    levels = " union all ".join(f"select {k} as level, {'lang' if k < 2 else 'null'} as lang, {'source' if k < 1 else 'null'} as source, text, g0, g1, g2, g3 from g where not base_failed" for k in range(3))
    measure = {
        0: "ln(1 + 100 * n_symbols / n)", 1: "word_chars / n", 2: "n_repeat_words / n", 3: "ln(1 + 100 * n_dup_lines / n)"}
    return f"""
with t as (select row_number() over () as k, doc_id, lang, source, coalesce(text, '') as text from documents
), w as (select k, regexp_extract_all(text, '{WORD}') as w from t
), tok as (select k, unnest(w) as x, generate_subscripts(w, 1) as i, len(w) as n from w
), tri as (select k, i, n, x, lead(x, 1) over (partition by k order by i) as x1, lead(x, 2) over (partition by k order by i) as x2 from tok
), dup as (select k, i, count(*) over (partition by k, x, x1, x2) as c from tri where i <= n - 2
), hit as (select distinct k, i + o as i from dup, (select unnest([0, 1, 2]) as o) where c > 1
), rep as (select k, count(*) as n_repeat_words from hit group by k
), chars as (select k, count(*) as n_words, sum(length(x)) as word_chars from tok group by k
), line as (select k, unnest(string_split(text, chr(10))) as l from t
), lines as (select k, count(*) - count(distinct l) as n_dup_lines from line where regexp_matches(l, '{WORD}') group by k
), base as (
  select doc_id, lang, source, text, coalesce(n_words, 0) as n_words, cast(coalesce(word_chars, 0) as bigint) as word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words
  from t left join chars using (k) left join lines using (k) left join rep using (k)
), marked as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, cast(greatest(n_words, 1) as double) as n from base
), g as (select *, {', '.join(f'cast(floor(({x}) * {rules.UNIT} + 0.5) as bigint) as g{i}' for i, x in measure.items())} from marked
), alike as (select distinct * from ({levels})
), good as materialized (select level, lang, source, g0, g1, g2, g3 from alike
), med as materialized ({begin}
), dev as (
  select a.level, a.lang, a.source, b.start, {', '.join(f'm{i}' for i in p)}, {', '.join(f'quantile_disc(abs(g{i} - m{i}), 0.5) as q{i}' for i in p)}
  from good a join med b on {same} group by a.level, a.lang, a.source, b.start, {', '.join(f'm{i}' for i in p)}
), d0 as (select a.*, b.start, {first} as d2 from good a join dev b on {same}
), {half('0')}, {steps}, best as (
  select * from e{rules.STEPS} qualify row_number() over (partition by {keys} order by l00 * l11 * l22 * l33, start) = 1
), {distances('n', 'good', 'best', same, keys)}, near as (
  select {keys}, {', '.join(f'cast({c} as double) as {c}' for c in names)} from (select {keys}, {sums} from dn where d2 <= {rules.NEAR} group by {keys})
), {factor('z', 'near', keys, rules.CONSISTENT_NEAR)}, size as (select distinct level, lang, source, texts from med
), pick as (
  select a.lang as for_lang, a.source as for_source, case when a.texts >= {rules.LEAST} then 0 when b.texts >= {rules.LEAST} then 1 else 2 end as level
  from size a join size b on a.level = 0 and b.level = 1 and a.lang is not distinct from b.lang
), judge as (
  select p.for_lang as lang, p.for_source as source, z.* exclude ({keys}) from pick p join ez z on p.level = z.level
    and (p.level = 2 or p.for_lang is not distinct from z.lang) and (p.level > 0 or p.for_source is not distinct from z.source)
), {distances('q', 'g', 'judge', 'a.lang is not distinct from b.lang and a.source is not distinct from b.source', 'lang, source')}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and coalesce(d2 <= {rules.CUTOFF}, false) as kept, round(d2, 6) as distance2 from dq"""


def mixing() -> str:
    return f"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) as size, cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 15) as bigint) as h from documents
), s as (
  select source, cast(sum(size) as bigint) as source_size, [3, 1, 2][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight from d group by source
), c as (
  select *, sum(source_size) over () as whole, sum(weight) over () as weights,
    coalesce(sum(2 * source_size) over before, 0) as stopped, coalesce(sum(weight) over before, 0) as stopped_weight
  from s window before as (order by (2 * source_size)::double / weight, source nulls last rows between unbounded preceding and 1 preceding)
), l as (select *, (1.5::double * whole - stopped) / (weights - stopped_weight) as level from c
), t as (select source, source_size, least(2.0::double * source_size, weight * max(level) over ()) as target from l
), n as (select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as whole from t
), a as (
  select d.doc_id, d.size, d.h, n.source_size, n.target, n.whole, n.target - n.whole * n.source_size as need,
    sum(d.size) over (partition by d.source order by d.h) as upto, sum(d.size) over (partition by d.source, d.h) as tie
  from d join n on d.source is not distinct from n.source
)
select doc_id, cast(size as bigint) as size, source_size, target,
  cast(size * (whole + case when upto <= need or (upto - tie <= need and upto - need < need - (upto - tie)) then 1 else 0 end) as bigint) as taken from a"""


def checksum(text: str) -> str:
    """CRC-32 of a short ASCII text, bit by bit."""
    bits = f"list_transform(range(8 * length({text})), lambda i: (ascii(substr({text}, i // 8 + 1, 1)) >> (i % 8)) & 1)"
    return f"xor(list_reduce({bits}, lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1)), 4294967295), 4294967295)"


#: Levels of eight children in the statement: more than any table here has.
MERKLE_LEVELS = 8


def merkle() -> str:
    def field(x: str) -> str:
        return f"coalesce(octet_length(encode({x}::varchar))::varchar || ':' || {x}::varchar, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"

    def climb(t: str, f: str) -> str:
        out = []
        for k in range(MERKLE_LEVELS):
            frame = "over (partition by g, idx // 8 order by idx rows between"
            out.append(f"""{t}s{k} as (select *, coalesce(string_agg(digest, '') {frame} unbounded preceding and 1 preceding), '') as before,
  coalesce(string_agg(digest, '') {frame} 1 following and unbounded following), '') as after from {t}{k}
), {t}{k + 1} as (select g, idx // 8 as idx, case when any_value(n) > 1 then sha256(string_agg(digest, '' order by idx)) else any_value(digest) end as digest, (any_value(n) + 7) // 8 as n
  from {t}{k} group by g, idx // 8
), {f}{k + 1} as (select f.* exclude (cur, proof), case when s.n > 1 then sha256(s.before || cur || s.after) else cur end as cur, proof || s.before || s.after as proof
  from {f}{k} f join {t}s{k} s on f.g is not distinct from s.g and f.pos // {8**k} = s.idx)""")
        return ", ".join(out)

    return f"""
with d as (
  select *, case when {checksum('doc_id::varchar')} % 3 = 0 then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end as other from documents
), l as (select doc_id, lang as g, {leaf('text')} as leaf, {leaf('other')} as cur, '' as proof from d
), a0 as (select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as pos from l
), t0 as (select g, pos as idx, leaf as digest, count(*) over (partition by g) as n from a0
), {climb('t', 'a')}, u0 as (select 0 as g, row_number() over (order by g nulls first) - 1 as idx, digest, count(*) over () as n, g as lang from t{MERKLE_LEVELS}
), b0 as (select a.doc_id, a.leaf, a.cur, a.proof, 0 as g, u.idx as pos, u.digest as subroot from a{MERKLE_LEVELS} a join u0 u on a.g is not distinct from u.lang
), {climb('u', 'b')}
select b.doc_id, b.leaf, b.subroot, u.digest as root, sha256(b.proof) as proof_sha256, b.cur as folded_root, b.cur = u.digest as verified
from b{MERKLE_LEVELS} b join u{MERKLE_LEVELS} u on b.g = u.g"""


def collocations() -> str:
    return """
with piece as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as p from documents
), w as (select lang, regexp_extract_all(p, '[^\x20\x09]+') as w from piece
), total as (select lang, cast(sum(len(w)) as bigint) as n from w group by lang
), gram as (
  select lang, 1 as m, unnest(w) as phrase from w
  union all select lang, 2, array_to_string(w[i:i + 1], ' ') from (select lang, w, unnest(range(1, len(w))) as i from w)
  union all select lang, 3, array_to_string(w[i:i + 2], ' ') from (select lang, w, unnest(range(1, len(w) - 1)) as i from w)
), f as (select lang, m, phrase, count(*) as a from gram group by all having count(*) >= 10
), cut as (
  select lang, phrase, a, k, array_to_string(x[1:k], ' ') as head, array_to_string(x[k + 1:m], ' ') as tail
  from (select *, string_split(phrase, ' ') as x, unnest(range(1, m)) as k from f where m > 1)
), scored as (
  select c.*, h.a as l, t.a as r, cast((1000000::hugeint * c.a * c.a) // (h.a::hugeint * t.a) as bigint) as score
  from cut c join f h on c.lang = h.lang and c.head = h.phrase join f t on c.lang = t.lang and c.tail = t.phrase
), least_cut as (select *, row_number() over (partition by lang, phrase order by score, k) as nth from scored
), inside as (
  select lang, phrase, max(a) as longer from (
    select lang, a, array_to_string(x[i:i + 1], ' ') as phrase from (select *, string_split(phrase, ' ') as x, unnest([1, 2]) as i from f where m = 3)) group by all
), ranked as (
  select c.lang, c.phrase, c.a, c.l, c.r, c.score, row_number() over (partition by c.lang order by c.score desc, c.a desc, c.phrase) as rank
  from least_cut c left join inside i on c.lang = i.lang and c.phrase = i.phrase where nth = 1 and (longer is null or 100 * longer < 50 * c.a)
)
select lang, rank, phrase, a, l, r, n, score from ranked join total using (lang) where rank <= 2000"""


ORACLE = {
    "op12_merkle_manifest": merkle(),
    "op13_collocations": collocations(),
    "op2_exact_topk": topk(),
    "op6_url_filters": url_filter(),
    "op7_quality_rules": quality_rules(),
    "op8_source_mixing": mixing(),
}
