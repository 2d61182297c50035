"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

OP4 = r"""
with sized as (
    select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size,
           md5('mix-1:' || coalesce(cast(doc_id as varchar), '')) as draw
    from documents
), totals as (
    select source, cast(sum(size) as bigint) as source_size,
           row_number() over (order by source nulls last) as place
    from sized group by source
), weighed as (
    select *, [3, 1, 2][(place - 1) % 3 + 1] as weight, 2 * source_size as cap from totals
), filled as (
    select *, 1.5::double * sum(source_size) over () as wanted, sum(weight) over () as weights,
           coalesce(sum(cap) over before, 0) as caps_before,
           coalesce(sum(weight) over before, 0) as weights_before
    from weighed
    window before as (order by cap / weight, place rows between unbounded preceding and 1 preceding)
), clamped as (
    select *, (wanted - caps_before) * weight >= cap * (weights - weights_before) as full_up from filled
), levelled as (
    select *, (wanted - sum(case when full_up then cap else 0 end) over ())
              / nullif(weights - sum(case when full_up then weight else 0 end) over (), 0) as level
    from clamped
), targets as (
    select source, source_size,
           case when full_up then cast(cap as double) else level * weight end as target
    from levelled
), placed as (
    select s.*, source_size, target,
           coalesce(floor(target / nullif(source_size, 0)), 0) as whole,
           coalesce(sum(size) over (partition by s.source order by draw, doc_id, size
                    rows between unbounded preceding and 1 preceding), 0) as start
    from sized s join targets t on s.source is not distinct from t.source
)
select doc_id, cast(size as bigint) as size, source_size, target,
       cast(size * least(2, whole + case when 2 * start + size <= 2 * (target - whole * source_size)
                                 then 1 else 0 end) as bigint) as taken
from placed
"""

OP8 = r"""
with parsed as (
    select page_id,
           coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
           coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
    from pages
), rules(verdict, rule_host, rule_path) as (
    values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
           ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), ruled as (
    select p.*, (select max_by(rule_host || rule_path, length(rule_host || rule_path)) from rules
                 where (host = rule_host or ends_with(host, '.' || rule_host))
                   and starts_with(path, rule_path)) as rule
    from parsed p
), outcomes as (
    select r.*, v.verdict as ruled from ruled r left join rules v on rule = rule_host || rule_path
), hosts as (
    select host, case when address then name else regexp_extract(name, '([^.]*\.)?(?:' || ending, 0)
                 end as domain,
           case when address then '(address)' else regexp_extract(name, '(^|\.)((?:' || ending || ')', 2)
                 end as suffix, pages, good
    from (select *, regexp_matches(name, '^([0-9]+(\.[0-9]+){3}|\[.*\])\z') as address,
                 '(?:ac|co|com|edu|go|gov|ne|net|or|org)\.[a-z][a-z]|blogspot\.com|github\.io|gitlab\.io'
                 || '|herokuapp\.com|netlify\.app|pages\.dev|substack\.com|vercel\.app|web\.app'
                 || '|wordpress\.com|[^.]*)\z' as ending
          from (select host, regexp_replace(regexp_replace(host, '(?s)^.*@', ''), ':[0-9]*\z', '') as name,
                       count(ruled) as pages, count(*) filter (ruled = 'allow') as good
                from outcomes group by host))
), s1 as (
    select suffix, sum(pages) as pages, sum(good) as good,
           (sum(sum(good)) over () + 1) / (sum(sum(pages)) over () + 2) as mean
    from hosts group by suffix
), s2 as (
    select *, greatest(0.01, least(0.9, coalesce(
               sum((good - pages * mean) ** 2 - pages * mean * (1 - mean)) over ()
               / nullif(sum(pages * (pages - 1) * mean * (1 - mean)) over (), 0), 0))) as rho from s1
), s3 as (
    select *, (good + (1 - rho) / rho * mean) / (pages + (1 - rho) / rho) as rate from s2
), d1 as (
    select h.suffix, domain, sum(h.pages) as pages, sum(h.good) as good, any_value(rate) as mean
    from hosts h join s3 using (suffix) group by h.suffix, domain
), d2 as (
    select *, greatest(0.01, least(0.9, coalesce(
               sum((good - pages * mean) ** 2 - pages * mean * (1 - mean)) over ()
               / nullif(sum(pages * (pages - 1) * mean * (1 - mean)) over (), 0), 0))) as rho from d1
), d3 as (
    select *, (good + (1 - rho) / rho * mean) / (pages + (1 - rho) / rho) as rate from d2
), h1 as (
    select h.*, rate as mean from hosts h join d3 using (domain)
), h2 as (
    select *, greatest(0.01, least(0.9, coalesce(
               sum((good - pages * mean) ** 2 - pages * mean * (1 - mean)) over ()
               / nullif(sum(pages * (pages - 1) * mean * (1 - mean)) over (), 0), 0))) as rho from h1
), h3 as (
    select host, (good + (1 - rho) / rho * mean) / (pages + (1 - rho) / rho) as rate,
           pages + (1 - rho) / rho as weight from h2
)
select page_id, host, path, rule,
       coalesce(ruled, case when rate + 1.645 * sqrt(rate * (1 - rate) / (weight + 1)) < 0.5
                       then 'block' else 'allow' end) as verdict
from outcomes join h3 using (host)
"""

OP11 = r"""
with pieces as (
    select row_number() over () as piece, lang, regexp_extract_all(part, '[^\x20\x09]+') as words
    from (select coalesce(lang, 'und') as lang, unnest(string_split_regex(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[.,;:!?\x0A-\x0D]')) as part from documents)
), totals as (
    select lang, cast(sum(len(words)) as bigint) as n from pieces group by lang
), places as (
    select lang, words, unnest(range(1, len(words) + 1)) as i from pieces
), frequent as (
    select lang, words[i:i + k - 1] as words, k, count(*) as a
    from places, range(1, 6) as lengths(k) where i + k - 1 <= len(words)
    group by all having count(*) >= 100
), cuts as (
    select f.lang, f.words, f.k, f.a, first.a as l, rest.a as r, n,
           cast(1000::hugeint * f.a * n // (first.a::hugeint * rest.a) as bigint) as score, cut
    from frequent f, range(1, 5) as cuts(cut)
    join frequent first on first.lang = f.lang and first.words = f.words[1:cut]
    join frequent rest on rest.lang = f.lang and rest.words = f.words[cut + 1:]
    join totals on totals.lang = f.lang
    where f.k > 1 and cut < f.k
), worst as (
    select * from cuts qualify row_number() over (partition by lang, words order by score, cut) = 1
), inner_phrases as (
    select lang, words[i:j] as words, max(a) as longest
    from frequent, range(1, 5) as starts(i), range(2, 6) as ends(j)
    where j > i and j <= k and j - i + 1 < k group by all
), kept as (
    select w.* from worst w left join inner_phrases p on p.lang = w.lang and p.words = w.words
    where not coalesce(100 * longest >= 100 * a, false)
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank,
       phrase, a, l, r, n, score
from (select *, array_to_string(words, ' ') as phrase from kept)
qualify rank <= 2000
"""

OP12 = """
with vectors as (
    select row_number() over () as place, vec_id,
           list_transform(embedding, lambda x: floor(256 * cast(x as double))) as whole
    from embeddings
    where vec_id is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.place, q.vec_id as query_id, c.vec_id,
           cast(list_dot_product(q.whole, c.whole) as bigint) as score
    from vectors q join vectors c on q.place <> c.place and len(q.whole) = len(c.whole)
    where q.vec_id % 50 = 0
)
select query_id, cast(row_number() over (partition by place order by score desc, vec_id) as int) as rank,
       vec_id, score
from scored qualify rank <= 5
"""

ORACLES = {"op4_mixing": OP4, "op8_url_filter": OP8, "op11_phrases": OP11, "op12_topk": OP12}
