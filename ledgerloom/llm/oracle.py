"""DuckDB SQL for the queries that SQL expresses."""

from __future__ import annotations

from ledgerloom.llm.queries import URL_RULES

# Every word with its place; a window of eight words is told by its words joined by a space.
OP1 = r"""
with texts as (
  select row_number() over () as k, doc_id, coalesce(text, '') as text from documents
), split as (
  select k, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from texts
), placed as (
  select k, unnest(words) as word, generate_subscripts(words, 1) as i from split
), windows as (
  select k, i, word, lag(word) over w as before,
    case when lead(word, 7) over w is not null then concat_ws(' ', word, lead(word, 1) over w,
      lead(word, 2) over w, lead(word, 3) over w, lead(word, 4) over w, lead(word, 5) over w,
      lead(word, 6) over w, lead(word, 7) over w) end as eight
  from placed window w as (partition by k order by i)
), counted as (
  select k, i, word, before,
    (eight is not null and count(*) over (partition by k, eight) > 1)::int as again
  from windows
), covered as (
  select k, max(again) over (partition by k order by i rows between 7 preceding and current row) as inside,
    (word = before)::int as stutter,
    regexp_full_match(word, '[0-9.,;:!?#*$%&|<>()\[\]{}+\-=_/\\''"@^~`]*')::int as bare
  from counted
), sums as (
  select k, sum(inside) as repeats, sum(stutter) as stutters, sum(bare) as bares from covered group by k
), facts as (
  select doc_id, len(words) as n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
    len(lines) - len(list_distinct(lines)) as n_dup_lines,
    coalesce(repeats, 0)::bigint as n_repeat_words,
    coalesce(stutters, 0) as stutters, coalesce(bares, 0) as bares, len(lines) as n_lines,
    length(text) - length(regexp_replace(text, '[a-z]', '', 'g')) as small_letters,
    length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) as capitals,
    len(list_distinct(words)) as vocabulary,
    len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*(-|\*|•)'))) as bullets,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) as cut
  from split left join sums using (k)
), judged as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from facts
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed
    or n_symbols > 0.1::double * n_words
    or (capitals > small_letters and capitals >= 20)
    or word_chars < 2 * n_words or word_chars > 20 * n_words
    or n_dup_lines > greatest(2, 0.3::double * n_lines)
    or bares > 0.5::double * n_words
    or bullets > 0.9::double * n_lines
    or cut > 0.3::double * n_lines
    or stutters > 0.2::double * n_words
    or (n_words >= 50 and vocabulary < 0.05::double * pow(n_words, 0.9::double))) as kept
from judged
"""


def url_host(url: str) -> str:
    rest = f"case when strpos({url}, '://') > 0 then substr({url}, strpos({url}, '://') + 3) else '' end"
    return (f"translate(regexp_extract({rest}, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
            "'abcdefghijklmnopqrstuvwxyz')")


def url_path(url: str) -> str:
    rest = f"case when strpos({url}, '://') > 0 then substr({url}, strpos({url}, '://') + 3) else '' end"
    return f"regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1)"


def url_filter_sql(iterations: int = 8, damping: float = 0.85, least: float = 0.1) -> str:
    """The verdict of every page: fitting rules, then ranks that pass along the links."""
    rules = ", ".join(f"('{r.host}', '{r.path}', {str(r.allow).lower()})" for r in URL_RULES)
    d = f"{damping}::double"
    rounds = "".join(f""", ranks{k} as (
  select host, sum(trust) as trust, sum(distrust) as distrust from (
    select f.host, {d} * r.trust * f.trust_share as trust, {d} * r.distrust * f.distrust_share as distrust
    from flows f join ranks{k - 1} r on f.at = r.host
    union all select host, (1 - {d}) * trusted, (1 - {d}) * blocked from seeds) group by host
)""" for k in range(1, iterations + 1))
    return f"""
with rules(rule_host, rule_path, allow) as (values {rules}
), numbered as (
  select row_number() over () as k, page_id, html, {url_host("coalesce(url, '')")} as host,
    {url_path("coalesce(url, '')")} as path from pages
), fitting as (
  select k, arg_max(rule_host || rule_path, [length(rule_host), length(rule_path)]) as rule,
    arg_max(allow, [length(rule_host), length(rule_path)]) as allow
  from numbered join rules on (host = rule_host or ends_with(host, '.' || rule_host))
    and starts_with(path, rule_path) group by k
), split as (
  select n.*, f.rule, f.allow from numbered n left join fitting f using (k)
), targets as (
  select host as src, unnest(regexp_extract_all(html,
    '(?is)<a\\s[^>]*?href\\s*=\\s*["'']?((?:https?:)?//[^"''\\s>]+)', 1)) as target
  from split where host <> ''
), pairs as (
  select src, {url_host("case when starts_with(target, '//') then 'http:' || target else target end")} as dst
  from targets
), links as (
  select src, dst, count(*) as n from pairs where dst <> '' and src <> dst group by src, dst
), flows as (
  select src as at, dst as host, n / sum(n) over (partition by src) as trust_share, 0::double as distrust_share from links
  union all
  select dst, src, 0::double, n / sum(n) over (partition by dst) from links
), hosts as (
  select host, count(*) filter (allow) as allowed, count(*) filter (not allow) as blocked from split group by host
), sums as (
  select count(*) filter (allowed > blocked) as good, count(*) filter (blocked > allowed) as bad, count(*) as every
  from hosts
), seeds as (
  select host, case when allowed > blocked then 1::double / good else 0 end as trusted,
    case when blocked > allowed then 1::double / bad else 0 end as blocked
  from hosts, sums where allowed <> blocked
), ranks0 as (
  select host, trusted as trust, blocked as distrust from seeds
){rounds}, known as (
  select r.host, r.trust - (1 - {d}) * coalesce(s.trusted, 0) as trust,
    r.distrust - (1 - {d}) * coalesce(s.blocked, 0) as distrust
  from ranks{iterations} r left join seeds s using (host)
)
select page_id, p.host, path, rule,
  case when coalesce(allow, not coalesce(distrust >= {least}::double / every and distrust > trust, false))
    then 'allow' else 'block' end as verdict
from split p cross join sums left join known k on p.host = k.host
"""



OP12 = r"""
with docs as (
  select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents
), words as (
  select d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs
), kept as (
  select lang, term, count(*) as in_lang from words group by lang, term having count(distinct d) >= 10
), langs as (
  select lang, count(*) as v, sum(in_lang) as total from kept group by lang
), counts as (
  select lang, source, term, count(*) as n from words join kept using (lang, term) group by lang, source, term
), totals as (
  select lang, source, sum(n) as total from counts group by lang, source
), every as (
  select distinct lang, source from docs
), grid as (
  select e.lang, e.source, k.term, coalesce(c.n, 0) as n,
    1 + 1000000000::hugeint * (coalesce(c.n, 0) + 2) // (coalesce(t.total, 0) + 2 * l.v)::hugeint as p,
    1 + 1000000000::hugeint * (k.in_lang + 2) // (l.total + 2 * l.v)::hugeint as q
  from every e join kept k using (lang) join langs l using (lang)
  left join totals t on t.lang = e.lang and t.source = e.source
  left join counts c on c.lang = e.lang and c.source = e.source and c.term = k.term
), apart as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
  from grid a join grid b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(x.value, 0)::bigint as value
  from every a join every b on a.lang = b.lang and a.source <> b.source
  left join apart x on x.lang = a.lang and x.source = a.source and x.item = b.source
), terms as (
  select lang, source, 'term' as part, term as item, ((p - q) * (p - q) // (p + q))::bigint as value
  from grid where n > 0 and p > q
), ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank
  from (select * from pairs union all select * from terms)
)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 10
"""

OP13 = r"""
with docs as (
  select row_number() over () as k, doc_id, coalesce(text, '') as text, coalesce(source, '') as part from documents
), facts as (
  select k, doc_id, part, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words, length(text) as size,
    length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) as capitals,
    regexp_matches(text, '[#$%&*|]') as marks,
    coalesce(doc_id > min(doc_id) over (partition by text), false) as again
  from docs
), known as (
  select doc_id, max(coalesce(quality = 1, false)::int) as good, max(coalesce(toxic = 1, false)::int) as toxic
  from labels group by doc_id
), masks as (
  select part, (len(words) < 50)::int + 2 * (100 * len(list_distinct(words)) < 65 * len(words))::int
      + 4 * (100 * capitals > 5 * size)::int + 8 * marks::int + 16 * again::int as mask,
    count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic
  from facts left join known on known.doc_id = facts.doc_id group by all
), letters(letter, bit) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), orders as (
  select a.letter || b.letter || c.letter || d.letter || e.letter as filter_order,
    [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from letters a, letters b, letters c, letters d, letters e
  where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps as (
  select filter_order, s::int as step, bits[s] as bit, coalesce(list_sum(bits[1:s - 1]), 0)::bigint as before
  from orders, range(1, 6) t(s)
), found as (
  select part, filter_order, step, bit,
    sum(n) filter (mask & (before | bit) = 0) as kept,
    sum(n) filter (mask & bit <> 0 and mask & before = 0) as removed,
    sum(n) filter (mask & bit <> 0 and mask & before <> 0) as redundant,
    sum(n) filter (mask = bit) as unique_fails,
    sum(good) filter (mask & bit <> 0 and mask & before = 0) as good_lost,
    sum(toxic) filter (mask & bit <> 0 and mask & before = 0) as toxic_lost
  from masks, steps group by all
)
select part, filter_order, step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed,
  coalesce(redundant, 0)::bigint as redundant, coalesce(unique_fails, 0)::bigint as unique_fails,
  coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost,
  (sum(coalesce(removed, 0)) over (partition by part, bit))::bigint as shapley
from found
"""

ORACLES: dict[str, str] = {
    "op1_quality_rules": OP1, "op3_url_filter": url_filter_sql(), "op12_divergence": OP12,
    "op13_interaction_audit": OP13}
