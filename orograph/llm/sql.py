"""DuckDB SQL for the queries of this subpackage that SQL can express, written from their contracts and parameters."""

from __future__ import annotations

from . import licenses, quality, url_filter
from .native import LOW, UPPER

PLAIN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLANK = r"[\x20\x09-\x0D]+"


def text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def words(expression: str, between: str) -> str:
    return f"list_filter(string_split_regex({expression}, '{between}'), lambda x: x <> '')"


def lowered(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{UPPER}', '{LOW}')"


DECONTAMINATE = f"""with w as (select doc_id, {words(lowered('text'), PLAIN)} as ws from documents),
items as (select coalesce(item_id::varchar, '') as item, {words(lowered('text'), PLAIN)} as ws from benchmark),
windows as (select distinct item, n, ws[i:i + n - 1] as g from (select item, ws, least(10, len(ws)) as n, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) as i from items where len(ws) > 0)),
places as (select doc_id, i, n, ws[i:i + n - 1] as g from (select doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) as i from w, (select distinct n from windows) where len(ws) >= n)),
hits as (select doc_id, i, n, item from places join windows using (g, n)),
covered as (select distinct doc_id, unnest(range(i, i + n)) - 1 as p from hits),
spans as (select doc_id, min(p) as a, max(p) + 1 as b from (select doc_id, p, p - row_number() over (partition by doc_id order by p) as island from covered) group by doc_id, island),
of_words as (select doc_id, sum(b - a)::bigint as n_hit, string_agg(a || '-' || b, ',' order by a) as hit_spans from spans group by doc_id),
of_items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids from (select distinct doc_id, item from hits) group by doc_id)
select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated, coalesce(hit_spans, '') as hit_spans
from w left join of_words using (doc_id) left join of_items using (doc_id)"""


def count_of(column: str, chars: str) -> str:
    return f"(length({column}) - length(translate({column}, {text(chars)}, '')))"


def quality_rules() -> str:
    phrases = " or ".join(f"contains(lower(l), {text(x)})" for x in quality.FURNITURE)
    links = count_of("l", quality.LINKS)
    fails = f"(n < 5 and not regexp_matches(l, {text(quality.ENDS)})) or {count_of('l', quality.SYMBOLS)} > 0.1::double * length(l) or ({links} >= 3 and {links} > 0.2::double * n) or (n <= 40 and ({phrases}))"
    return f"""with d as (select doc_id, coalesce(text, '') as t, {words("coalesce(text, '')", BLANK)} as ws from documents),
lines as (select doc_id, l, len({words('l', BLANK)}) as n from (select doc_id, unnest(string_split(t, chr(10))) as l from d)),
by_line as (select doc_id, sum(case when n > 0 and not ({fails}) then n else 0 end)::bigint as n_kept_words, (count(*) filter (where n > 0) - count(distinct l) filter (where n > 0))::bigint as n_dup_lines from lines group by doc_id),
triples as (select doc_id, i, count(*) over (partition by doc_id, g) as k from (select doc_id, i, ws[i:i + 2] as g from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from d where len(ws) > 2))),
repeats as (select doc_id, count(distinct p) as r from (select doc_id, unnest([i, i + 1, i + 2]) as p from triples where k > 1) group by doc_id),
counted as (select doc_id, len(ws)::bigint as n_words, length(regexp_replace(t, '{BLANK}', '', 'g'))::bigint as word_chars, {count_of('t', quality.SYMBOLS)}::bigint as n_symbols, n_dup_lines, coalesce(r, 0)::bigint as n_repeat_words, n_kept_words
  from d join by_line using (doc_id) left join repeats using (doc_id))
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and n_kept_words >= 0.5::double * n_words as kept from counted"""


def license_scan() -> str:
    phrases = ", ".join(f"({text(label)}, [{', '.join(map(text, p.split()))}])" for p, label in licenses.PHRASES.items())
    templates = ", ".join(f"({i}, {text(label)}, {licenses.need(t, 0.9)}, {licenses.width(t, 0.9)}, [{', '.join(map(text, licenses.tokens(t)))}])" for i, (label, t) in enumerate(licenses.TEMPLATES))
    return f"""with w as (select doc_id, {words(lowered('text'), PLAIN)} as ws from documents),
phrases(label, p) as (values {phrases}), templates(t, label, need, width, own) as (values {templates}),
places as (select doc_id, label, i - 1 as place from (select doc_id, ws, unnest(range(1, len(ws) + 1)) as i from w), phrases where ws[i:i + len(p) - 1] = p),
base as (select doc_id, count(*) as n_base, min(place) as first_word, max(place) as last_word, list_sort(list_distinct(list(label))) as labels from places group by doc_id),
vocabulary as (select t, need, width, unnest(own) as word from templates),
placed as (select doc_id, ws[i] as word, i from (select doc_id, ws, unnest(range(1, len(ws) + 1)) as i from w)),
able as (select doc_id, t from placed join vocabulary using (word) group by doc_id, t, need having count(distinct word) >= need),
own as (select doc_id, t, need, width, word, i from placed join vocabulary using (word) join able using (doc_id, t)),
windows as (select a.doc_id, a.t, a.i, count(distinct b.word) as n from own a join own b on a.doc_id = b.doc_id and a.t = b.t and b.i between a.i and a.i + a.width - 1 group by a.doc_id, a.t, a.i, a.need having count(distinct b.word) >= a.need),
matched as (select doc_id, list_distinct(list(label)) as labels, max(n::double / len(own)) as c from windows join templates using (t) group by doc_id)
select w.doc_id, len(ws)::bigint as n_words, coalesce(n_base, 0) as n_base, first_word, last_word, coalesce(array_to_string(base.labels, ','), '') as base_labels,
  array_to_string(list_sort(list_distinct(coalesce(base.labels, []) || coalesce(matched.labels, []))), ',') as labels, case when base.labels is not null then 1.0::double else coalesce(c, 0.0::double) end as score
from w left join base using (doc_id) left join matched using (doc_id)"""


def parsed(table: str, more: str) -> str:
    rest = "case when contains(url, '://') then substring(url, strpos(url, '://') + 3) else '' end"
    return f"""(select {more}, translate(h, '{UPPER}', '{LOW}') as host, regexp_extract(substring(r, length(h) + 1), '^[^?#]*') as path
    from (select *, regexp_extract(r, '^[^/?#]*') as h from (select *, coalesce({rest}, '') as r from {table})))"""


def url_judgement() -> str:
    rule = verdict = ""
    for what, r in sorted(url_filter.RULES, key=lambda r: -len(r[1])):
        name, _, prefix = r.partition("/")
        fits = f"when (host = {text(name)} or ends_with(host, {text('.' + name)})) and starts_with(path, {text('/' + prefix)})"
        rule, verdict = rule + f" {fits} then {text(r)}", verdict + f" {fits} then {text(what)}"
    two = "array_to_string(list_slice(string_split(host, '.'), -2, -1), '.')"
    three = "array_to_string(list_slice(string_split(host, '.'), -3, -1), '.')"
    last = "list_slice(string_split(host, '.'), -1, -1)[1]"
    second = "list_slice(string_split(host, '.'), -2, -2)[1]"
    known = f"regexp_full_match(last_, '[a-z][a-z]') and second_ in ({', '.join(map(text, url_filter.SECOND))})"

    def level(name: str, source: str) -> str:
        """A level's posterior: its prior's strength by moments over all rows of the level."""
        return f"""{name}_m as (select greatest(1.0, least(10000.0, greatest(1.0, (select n + 2 from every)), case when over_ > 0 and room <> 0 then room / over_ - 1 else 10000.0 end))::double as m
    from (select sum(n * (bad / n - parent) * (bad / n - parent) - parent * (1 - parent)) as over_, sum((n - 1) * parent * (1 - parent)) as room from (select n::double as n, bad::double as bad, parent from {source} where n > 0))),
  {name}_p as (select *, (m * parent + bad) / (m + n) as mean, (m * parent + bad) * (m * (1 - parent) + n - bad) / ((m + n) * (m + n) * (m + n + 1)) as var from {source}, {name}_m)"""

    return f"""with own as {parsed('pages', 'page_id, url')},
  seen as (select host, bad from (select host, case when regexp_extract(path, '/([0-9]{{1,18}})', 1) <> '' then regexp_extract(path, '/([0-9]{{1,18}})', 1)::bigint end as doc_id from own)
    join (select doc_id, max(case when quality = 0 or toxic = 1 then 1 else 0 end) as bad from labels group by doc_id) using (doc_id)),
  hosts as (select host, coalesce(n, 0) as n, coalesce(bad, 0) as bad, case when regexp_full_match(last_, '[0-9]+') then host when {known} then three_ else two_ end as domain,
      case when regexp_full_match(last_, '[0-9]+') then '' when {known} then two_ else last_ end as suffix
    from (select host, {last} as last_, {two} as two_, {second} as second_, {three} as three_ from (select distinct host from own)) left join (select host, count(*) as n, sum(bad) as bad from seen group by host) using (host)),
  every as (select sum(n) as n, sum(bad) as bad from hosts),
  s as (select suffix, sum(n) as n, sum(bad) as bad, (select (bad + 1.0::double) / (n + 2) from every) as parent from hosts group by suffix), {level('s', 's')},
  d as (select x.*, s_p.mean as parent from (select suffix, domain, sum(n) as n, sum(bad) as bad from hosts group by all) x join s_p using (suffix)), {level('d', 'd')},
  h as (select hosts.*, d_p.mean as parent from hosts join d_p using (suffix, domain)), {level('h', 'h')}
select page_id, host, path, case{rule} end as rule, round(mean, 9) as bad_rate, round(mean - 1.645::double * sqrt(var), 9) as bound, case{verdict} when mean - 1.645::double * sqrt(var) > 0.25 then 'block' else 'allow' end as verdict
from own join h_p using (host)"""

