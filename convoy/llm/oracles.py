"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from math import ceil

from convoy.llm.clusters import CENTROIDS, DIMS, SALT
from convoy.llm.clusters import ROUNDS as CLUSTER_ROUNDS
from convoy.llm.clusters import SCALE as CLUSTER_SCALE
from convoy.llm.codes import ENTRIES, PARTS
from convoy.llm.codes import ROUNDS as CODE_ROUNDS
from convoy.llm.codes import SCALE as CODE_SCALE
from convoy.llm.licenses import CONTAINED, NOTICES, PHRASES, WIDTH, notice_tokens

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{_BETWEEN}'), lambda w: w <> '')"


def _listed(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def license_sql(threshold: float = CONTAINED) -> str:
    """The digest of the license scan; every notice is compared with every block.

    Wrapped sentences are compared from each word of the notice on, if they hold enough of them.
    """
    places, base, notices = [], [], []
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        match = " and ".join(f"words[i + {k + 1}] = '{p}'" for k, p in enumerate(parts))
        places.append(
            f"list_filter(range(0, greatest(len(words) - {len(parts) - 1}, 0)), lambda i: {match})"
        )
        base.append(f"case when len(places[{len(base) + 1}]) > 0 then '{label}' end")
    for label, tokens in notice_tokens(NOTICES).items():
        need = ceil(threshold * len(tokens) - 1e-9)
        shared = f"len(list_intersect({_listed(sorted(tokens))}, b))"
        listed, width = _listed(sorted(tokens)), WIDTH * len(tokens)
        nearby = (
            f"list_max(list_transform(list_filter(range(1, len(b) + 1), "
            f"lambda i: list_contains({listed}, b[i])), "
            f"lambda i: len(list_intersect({listed}, b[i:i + {width - 1}]))))"
        )
        best = (
            f"greatest(list_max(list_transform(blocks, lambda b: {shared})), "
            f"list_max(list_transform(list_filter(wrapped, lambda b: {shared} >= {need}), "
            f"lambda b: {nearby})))"
        )
        notices.append(
            f"{{'label': '{label}', 'share': case when {best} >= {need} "
            f"then {best} / {float(len(tokens))}::double end}}"
        )
    return f"""
    with lowered as (
      select doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') as lower
      from documents),
    split as (
      select doc_id, {_words('lower')} as words,
             list_transform(
               regexp_split_to_array(
                 regexp_replace(lower, '([.!?;])[ \\t]+', '\\1' || chr(10), 'g'), '\\n+'),
               lambda b: list_distinct({_words('b')})) as blocks,
             list_transform(
               list_filter(
                 string_split(
                   regexp_replace(
                     regexp_replace(translate(lower, chr(1), '#'),
                       '([.!?;])[\\x09-\\x0D ]+', '\\1' || chr(1), 'g'),
                     '\\n[ \\t\\r]*\\n[\\x09-\\x0D ]*', chr(1), 'g'),
                   chr(1)),
                 lambda b: contains(b, chr(10))),
               lambda b: {_words('b')}) as wrapped
      from lowered),
    found as (
      select doc_id, words, [{', '.join(places)}] as places,
             list_filter([{', '.join(notices)}], lambda n: n.share is not null) as notices
      from split),
    named as (
      select doc_id, len(words) as n_words, flatten(places) as places, notices,
             list_filter([{', '.join(base)}], lambda x: x is not null) as base
      from found)
    select doc_id, n_words, len(places)::bigint as n_base,
           list_min(places)::bigint as first_word, list_max(places)::bigint as last_word,
           array_to_string(list_sort(base), ',') as base_labels,
           array_to_string(list_sort(list_distinct(
             list_concat(base, list_transform(notices, lambda n: n.label)))), ',') as labels,
           case when len(base) > 0 then 1.0::double
                else coalesce(list_max(list_transform(notices, lambda n: n.share)), 0.0)::double
           end as score
    from named"""


def _floor_mean(value: str) -> str:
    """The exact floor of a mean of whole numbers."""
    total, count = f"sum({value})::hugeint", "count(*)"
    return f"(({total} - (({total} % {count}) + {count}) % {count}) // {count})::bigint"


def _finite(vector: str) -> str:
    bad = "x is null or isnan(x) or isinf(x)"
    return f"{vector} is not null and len(list_filter({vector}, lambda x: {bad})) = 0"


def _grid(scale: int) -> str:
    return f"list_transform(embedding, lambda x: floor({scale} * x::double))"


# A squared distance in whole numbers, which doubles hold exactly here.
_GAP = """(list_inner_product(v.p, v.p) - 2 * list_inner_product(v.p, c.p)
          + list_inner_product(c.p, c.p))::bigint"""


def cluster_sql(
    centroids: int = CENTROIDS, rounds: int = CLUSTER_ROUNDS, dims: int = DIMS
) -> str:
    """Rounds of a full scan: every vector with every centroid."""
    steps = []
    for t in range(rounds + 1):
        steps.append(f"""
    a{t} as materialized (
      select vec_id, any_value(p) as p, min(key) // 1000 as d, min(key) % 1000 as c
      from (select v.vec_id, v.p, {_GAP} * 1000 + c.c as key from v, c{t} c)
      group by vec_id)""")
        if t < rounds:
            steps.append(f"""
    m{t} as materialized (
      select c, list(m::double order by place) as p
      from (select c, place, {_floor_mean('p[place]::bigint')} as m
            from a{t}, range(1, {dims + 1}) r(place) group by c, place)
      group by c),
    c{t + 1} as materialized (
      select c.c, coalesce(m.p, c.p) as p from c{t} c left join m{t} m on c.c = m.c)""")
    last = rounds
    return f"""
    with v as materialized (
      select vec_id, {_grid(CLUSTER_SCALE)} as p from embeddings
      where {_finite('embedding')} and len(embedding) = {dims}),
    c0 as materialized (
      select row_number() over (order by h) - 1 as c, p
      from (select sha256('{SALT}:' || vec_id) as h, p from v order by h limit {centroids})),
    {','.join(steps)}
    select vec_id, a.c::int as cluster, d as distance,
           sum(d) over (partition by a.c)::bigint as cluster_inertia,
           sum(d) over ()::bigint as inertia,
           sha256(array_to_string(list_transform(c.p, lambda x: x::bigint), ','))
             as centroid_sha256
    from a{last} a join c{last} c on a.c = c.c"""


def code_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = CODE_ROUNDS) -> str:
    """Rounds of a full scan: every part with every entry of its position."""
    steps = []
    for t in range(rounds + 1):
        steps.append(f"""
    a{t} as materialized (
      select vec_id, part, any_value(label) as label, any_value(p) as p,
             min(key) // 1000 as d, min(key) % 1000 as c
      from (select v.*, {_GAP} * 1000 + c.c as key from v join c{t} c using (part))
      group by vec_id, part)""")
        if t < rounds:
            steps.append(f"""
    m{t} as materialized (
      select part, c, list(m::double order by place) as p
      from (select part, c, place, {_floor_mean('p[place]::bigint')} as m
            from a{t}, range(1, {DIMS // parts + 1}) r(place) group by part, c, place)
      group by part, c),
    c{t + 1} as materialized (
      select c.part, c.c, coalesce(m.p, c.p) as p
      from c{t} c left join m{t} m on c.c = m.c and c.part = m.part)""")
    width = DIMS // parts
    return f"""
    with whole as materialized (
      select vec_id, label, {_grid(CODE_SCALE)} as p from embeddings
      where {_finite('embedding')}),
    v as materialized (
      select vec_id, label, part, p[part * {width} + 1:part * {width} + {width}] as p
      from whole, range({parts}) r(part)),
    c0 as materialized (
      select part, c, p[part * {width} + 1:part * {width} + {width}] as p
      from (select row_number() over (order by vec_id) - 1 as c, p
            from (select * from whole order by vec_id limit {entries})),
           range({parts}) r(part)),
    {','.join(steps)},
    coded as (
      select vec_id, any_value(label) as label,
             string_agg(format('{{:02x}}', c), '' order by part) as code,
             sum(d)::bigint as error
      from a{rounds} group by vec_id)
    select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error,
           (select sha256(string_agg(array_to_string(
              list_transform(p, lambda x: x::bigint), ','), ',' order by part, c))
            from c{rounds}) as codebooks_sha256
    from coded"""


ORACLES: dict[str, str] = {
    "op3_license_scan": license_sql(),
    "op11_clusters": cluster_sql(),
    "op12_codes": code_sql(),
}
