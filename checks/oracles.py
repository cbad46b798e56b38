"""The queries of ``checks/queries.py`` as DuckDB SQL over the same tables."""

from __future__ import annotations

CATEGORY = "(1, 2, 3, 4, 11, 12, 13, 18, 19, 57, 59)"
PRESENT = f"(f in {CATEGORY} or v > 0)"
GROUPS = {
    "query_detail": "f between 131 and 10130",
    "query_stat": "f between 10131 and 10233",
    "app_duration": "f between 10234 and 40180",
    "app_days": "f between 40181 and 68114",
    "app_times": "f between 68115 and 96048",
    "app_install": "f between 96051 and 96116 and (f - 96051) % 4 = 0",
    "app_open_time": "f between 96052 and 96116 and (f - 96052) % 4 = 0",
}
GROUP = "case " + " ".join(f"when {rule} then '{name}'" for name, rule in GROUPS.items()) + " end"


def month(ordinal: str) -> str:
    return f"printf('%04d-%02d', (({ordinal}) - 1) // 12, (({ordinal}) - 1) % 12 + 1)"


def bins(x: str) -> str:
    return f"case when {x} < 0.2 then 0 when {x} < 0.4 then 1 when {x} < 0.6 then 2 when {x} < 0.8 then 3 else 4 end"


def trim(x: str) -> str:
    return f"greatest(lo, least(hi, {x}))"


def scale(x: str) -> str:
    return f"case when lo = hi then {x} else greatest(0.0, least(1.0, ({x} - lo) / (hi - lo))) end"


USERS = """
users as (
  with mx as (select o_custkey as u, max(year(o_orderdate) * 12 + month(o_orderdate)) as mm from orders group by o_custkey)
  select c_custkey as u, case when c_acctbal < 0 then 1 else 0 end as label,
         mm + (case when c_custkey % 50 = 7 then 24 when c_custkey % 2 = 0 then 0 else 1 end) as lm
  from customer join mx on u = c_custkey)"""

OBS = """
obs as (
  with o as (select o_custkey as u, o_orderkey as ok, year(o_orderdate) * 12 + month(o_orderdate) as m from orders),
  num as (
    select u, m, case l_suppkey % 7 when 0 then 131 + l_partkey % 3 when 1 then 10131 + l_partkey % 2
                   when 2 then 10234 + l_partkey % 3 when 3 then 40181 + l_partkey % 2 when 4 then 68115 + l_partkey % 2
                   when 5 then 96051 + 4 * (l_partkey % 2) else 96052 + 4 * (l_partkey % 2) end as f,
           sum(case when l_discount = 0 then 0.0 else l_quantity end) as v
    from o join lineitem on l_orderkey = ok group by 1, 2, 3),
  c as (select u, m, max(ok) as ok, max(c_nationkey) as nk from o join customer on c_custkey = u group by u, m),
  cat as (
    select u, m, case when m % 2 = 0 then 1 else 57 end as f, (u + m) % 3 as v from c
    union all select u, m, case when u % 2 = 0 then 2 else 59 end, case when u % 2 = 0 then 1 + u % 7 else 16 + u % 45 end from c
    union all select u, m, 3, (u + m) % 19 from c
    union all select u, m, 4, ok % 33 from c
    union all select u, m, 11, ok % 2 from c
    union all select u, m, 12, u % 2 from c
    union all select u, m, 13, 0 from c
    union all select u, m, 18, 10 + nk from c
    union all select u, m, 19, ok % 342 from c)
  select x.u, label, lm - m as dist, cast(f as int) as f, cast(v as double) as v
  from (select u, m, f, cast(v as double) as v from num union all select u, m, f, cast(v as double) from cat) x
  join users on users.u = x.u where lm - m <= 12)"""


def _positions(source: str) -> str:
    """Values at positions floor(n * .05) and floor(n * .95) of each field."""
    return f"""
  select f, round(max(case when rn = cast(floor(n * cast(0.05 as double)) as bigint) then x end), 4) as lo,
         round(max(case when rn = cast(floor(n * cast(0.95 as double)) as bigint) then x end), 4) as hi
  from (select f, x, row_number() over (partition by f order by x) - 1 as rn, count(*) over (partition by f) as n
        from {source}) group by f"""


LISTS = f"""
nu as (select count(*) as n from users),
fu as (select f, count(distinct u) as users from obs where f not in {CATEGORY} group by f),
beh as (select f, row_number() over (order by f) - 1 as idx from fu),
cata as (select f, row_number() over (order by f) - 1 as idx from fu, nu where users >= cast(0.35 as double) * n),
catm as (select f, row_number() over (order by f) - 1 as idx from fu, nu where users >= cast(0.45 as double) * n),
grp as (select g, f, row_number() over (partition by g order by f) - 1 as idx
        from (select f, {GROUP} as g from fu) where g is not null),
rates as (select g, f, idx - 1 as idx from grp where idx > 0),
scored as (select f from fu where users >= 9),
best as (select f from fu order by users desc, f limit 100),
pr as (select a.f as l, b.f as r, row_number() over (order by a.f, b.f) - 1 as idx
       from scored a join scored b on a.f < b.f),
bpr as (select a.f as l, b.f as r, row_number() over (order by a.f, b.f) - 1 as idx
       from best a join best b on a.f < b.f),
rpr as (select l, r, 2 * idx as idx from bpr union all select r, l, 2 * idx + 1 from bpr),
outu as (select c_custkey as u from customer where c_acctbal >= 9900),
st as ({_positions("(select u, f, avg(v) as x from obs group by u, f)")}),
cs as (select * from ({_positions("(select u, f, max(v) - min(v) as x from obs group by u, f)")}) where lo <> hi)"""

BASE = f"with {USERS}, {OBS}"
FULL = f"{BASE}, {LISTS}"


def window(agg: str, k: int) -> str:
    return f"(select u, f, {agg} as x from obs where dist <= {12 - k} group by u, f)"


CHANGE = "max(v) - min(v)"


def trimmed(agg: str, k: int, where: str = "true", stats: str = "st") -> str:
    """Values of a window trimmed to the ranges of their fields."""
    return f"(select w.u, w.f, lo, hi, {trim('w.x')} as x from {window(agg, k)} w join {stats} s on s.f = w.f where {where.replace('f ', 'w.f ') if where != 'true' else where})"


def values(agg: str, k: int, fields: str) -> str:
    return f"select u, idx, x as value from {trimmed(agg, k)} t join {fields} c on c.f = t.f"


def onehot_values(agg: str, k: int, fields: str, stats: str = "st") -> str:
    x = scale("x")
    return f"select u, idx * 5 + {bins(x)} as idx, 1.0::double as value from {trimmed(agg, k, stats=stats)} t join {fields} c on c.f = t.f"


def changes(k: int, fields: str) -> str:
    return f"select u, idx, x as value from {window(CHANGE, k)} w join {fields} c on c.f = w.f"


def shares(k: int, group: str, fields: str) -> str:
    """``group`` selects from the trimmed values of the window; zero totals give no rows."""
    return f"""select u, idx, x / tot as value from (
      select u, f, x, sum(x) over (partition by u) as tot from {trimmed('avg(v)', k)} t where {group}) q
      join {fields} c on c.f = q.f where tot <> 0"""


def binned(triples: str) -> str:
    return f"select u, idx * 5 + {bins('value')} as idx, 1.0::double as value from ({triples})"


def rate(name: str) -> str:
    return f"(select f, idx from rates where g = '{name}')"


def own(name: str) -> str:
    return f"t.f in (select f from rates where g = '{name}')"


def pairs(k: int, table: str, x: str, value: str) -> str:
    return f"""select a.u, p.idx, {value} as value from {table} p
      join (select u, f, {x} as x from {trimmed('avg(v)', k)}) a on a.f = p.l
      join (select u, f, {x} as x from {trimmed('avg(v)', k)}) b on b.f = p.r and b.u = a.u"""


LOG = "case when a.x * b.x = 0 then 0.0 else ln(a.x * b.x) end"
RATIO = "case when b.x = 0 then 0.0 else a.x / b.x end"


def missing_of(k: int) -> str:
    return f"""select users.u, 5000 - count(distinct case when {PRESENT} and dist <= {12 - k} then f end) as missing
      from users left join obs on obs.u = users.u group by users.u"""


def missing_value(k: int) -> str:
    return f"select u, 0 as idx, missing::double as value from ({missing_of(k)})"


def missing_bin(k: int) -> str:
    x = "(missing - 10) / 4990.0::double"
    return f"select u, {bins(x)} as idx, 1.0::double as value from ({missing_of(k)})"


AGE = "1 + (c >= 18)::int + (c >= 22)::int + (c >= 25)::int + (c >= 30)::int + (c >= 40)::int + (c >= 50)::int"
MODEL = "case c when 2 then 1 when 11 then 2 when 12 then 3 when 16 then 4 when 17 then 5 else 0 end"
CODES = f"""codes as (
  select u, dist, f, case when f = 59 then {AGE} else c end as raw,
         case when f = 59 then {AGE} when f = 3 then {MODEL} when f in (18, 19) and c = 34 then 0 else c end as code
  from (select u, dist, f, cast(trunc(v) as int) as c from obs where f in {CATEGORY}))"""


def latest(fields: str, column: str = "code") -> str:
    return f"(select u, first({column} order by dist, f) as code from codes where f in {fields} group by u)"


def largest(fields: str) -> str:
    return f"(select u, greatest(max(code), 0) as code from codes where f in {fields} group by u)"


def every(fields: str) -> str:
    return f"(select distinct u, code from codes where f in {fields})"


SLOTS = [
    ("(1, 57)", 3, latest),
    ("(2, 59)", 8, latest),
    ("(3)", 6, every),
    ("(4)", 33, every),
    ("(11)", 2, largest),
    ("(12)", 2, largest),
    ("(13)", 2, largest),
    ("(18)", 34, every),
    ("(19)", 342, every),
]


def profile() -> str:
    parts, at = [], 0
    for fields, width, pick in SLOTS:
        parts.append(
            f"select users.u, {at} + coalesce(code, 0) as idx, 1.0::double as value from users left join {pick(fields)} p on p.u = users.u"
        )
        at += width
    return " union all ".join(parts)


def profile_numbers() -> str:
    parts, at = [], 0
    for fields, _, _ in SLOTS:
        parts.append(
            f"select users.u, {at} as idx, coalesce(code, 0)::double as value from users left join {latest(fields, 'raw')} p on p.u = users.u"
        )
        at += 1
        if fields in ("(18)", "(19)"):
            parts.append(
                f"select users.u, {at} as idx, count(f)::double as value from users left join codes on codes.u = users.u and f in {fields} group by users.u"
            )
            at += 1
    return " union all ".join(parts)


def size_of(fields: str) -> str:
    return f"(select count(*) from {fields})"


def window_blocks(k: int, average: str, maximum: str) -> list[tuple[str, str]]:
    """Blocks of a window layout as (triples, width)."""
    parts = [(profile(), "432"), (values("avg(v)", k, average), size_of(average)), (values("max(v)", k, maximum), size_of(maximum))]
    for name, rule in GROUPS.items():
        group = own(name) if name in ("app_install", "app_open_time") else rule.replace("f ", "t.f ")
        parts.append((shares(k, group, rate(name)), size_of(rate(name))))
    return [*parts, (missing_value(k), "1")]


YEAR_AND_HALF = [
    *[(shares(0, own(name), rate(name)), size_of(rate(name))) for name in GROUPS],
    (values("avg(v)", 0, "cata"), size_of("cata")),
    (values("max(v)", 0, "cata"), size_of("cata")),
    (values("avg(v)", 6, "cata"), size_of("cata")),
    (values("max(v)", 6, "catm"), size_of("catm")),
    (profile(), "432"),
    (missing_value(0), "1"),
    (missing_value(6), "1"),
]
LINEAR = [
    (profile(), "432"),
    (onehot_values("avg(v)", 6, "cata"), f"5 * {size_of('cata')}"),
    *[(binned(shares(6, own(name), rate(name))), f"5 * {size_of(rate(name))}") for name in GROUPS],
    (binned(pairs(6, "pr", scale("x"), LOG)), f"5 * {size_of('pr')}"),
    (onehot_values(CHANGE, 6, "cata", stats="cs"), f"5 * {size_of('cata')}"),
    (missing_bin(6), "5"),
]


def layout(blocks: list[tuple[str, str]], excluding: bool = True) -> str:
    """CTEs ending in ``laid(user, label, feature_size, idx, value)``."""
    parts, at = [], "1"
    for triples, width in blocks:
        parts.append(f"select u, {at} + idx as idx, value from ({triples})")
        at = f"{at} + {width}"
    kept = "where users.u not in (select u from outu)" if excluding else ""
    return f"""{FULL}, {CODES}, laid as (
      select users.u as user, label, cast({at} - 1 as int) as feature_size, cast(idx as int) as idx, value
      from ({" union all ".join(parts)}) b join users on users.u = b.u {kept})"""


def laid_out(blocks: list[tuple[str, str]], excluding: bool = True) -> str:
    return f'{layout(blocks, excluding)} select "user", label, feature_size, idx, round(value, 6) as value from laid'


TEXT = "case when length(value::varchar) >= 7 then printf('%.4f', round(value, 4)) else value::varchar end"
DENSE = f"case when cast({TEXT} as double) = 1.0 then '1' else printf('%.4f', round(cast({TEXT} as double), 4)) end"


def block(triples: str, extra: str = "") -> str:
    cte = f"{FULL}, {CODES}" if "codes" in triples else FULL
    return f'{cte} select u as "user", cast(idx as int) as idx, round(value, 6) as value from ({triples}) {extra}'


def numbered(fields: str, order: str = "f") -> str:
    return f"{FULL} select cast(f as int) as field_id, cast(row_number() over (order by {order}) - 1 as int) as idx from {fields}"


def predictions(multiplier: int, modulus: int) -> str:
    return f"(select u, label, ((u * {multiplier}) % {modulus})::double / {modulus} as s from users)"


GRID = f"""{BASE}, xy as (
  select a.s as x, b.s as y from {predictions(1, 101)} a join {predictions(1, 211)} b on a.u = b.u),
pl as (select rank() over (order by x) - 1 as xb, rank() over (order by y) - 1 as yb, count(*) over () as n from xy),
lv as (select *, cast(floor(pow(n, cast(0.6 as double))) as bigint) as l from pl),
ax as (select unnest(range(2, 1 + (select max(l) // 2 from lv))) as i),
gr as (select a.i as a, b.i as b, n, xb, yb from ax a join ax b on a.i * b.i <= (select max(l) from lv), lv),
ce as (select a, b, n, (xb * a) // n as bx, (yb * b) // n as bw, count(*) as c from gr group by all),
mg as (select *, sum(c) over (partition by a, b, bx) as cx, sum(c) over (partition by a, b, bw) as cy from ce),
sc as (select a, b, sum(c::double / n * ln(c::double * n / (cx * cy))) / ln(least(a, b)) as score from mg group by a, b)"""

def xlogx(n: str) -> str:
    return f"case when {n} = 0 then 0.0 else ({n}) * ln({n}) end"


# The best cuts of one axis against equal-count bins of the other: sums over columns, then one more column at a time.
CUTS = f"""with recursive {USERS}, xy as (
  select a.s as x, b.s as y from {predictions(1, 101)} a join {predictions(1, 211)} b on a.u = b.u),
pl as (select rank() over (order by x) - 1 as xb, rank() over (order by y) - 1 as yb, count(*) over () as n from xy),
lv as (select *, cast(floor(pow(n, cast(0.6 as double))) as bigint) as l from pl),
sd as (select 'x' as axis, xb as own, yb as other, n, l from lv union all select 'y', yb, xb, n, l from lv),
ce as (select axis, b, n, l // b as most, (own * (l // b) * 15) // n as s, (other * b) // n as r, count(*) as c
       from sd, (select unnest(range(2, 1 + (select max(l) // 2 from lv))) as b) group by all),
po as materialized (select *, dense_rank() over (partition by axis, b order by s) as i from ce),
gr as (select axis, b, i, r from (select distinct axis, b, i from po) join (select distinct axis, b, r from po) using (axis, b)
       union all select distinct axis, b, 0, r from po),
up as materialized (select axis, b, i, r, sum(coalesce(c, 0)) over (partition by axis, b, r order by i) as p from gr left join po using (axis, b, i, r)),
sg as materialized (select axis, b, s, t, sum({xlogx("d")}) - {xlogx("sum(d)")} as v from (
         select a.axis, a.b, a.i as s, z.i as t, z.p - a.p as d from up a join up z on a.axis = z.axis and a.b = z.b and a.r = z.r and a.i < z.i) group by axis, b, s, t),
nu as (select axis, b, max(most) as most, max(n) as n, max(i) as k from po group by axis, b),
rw as (select axis, b, sum({xlogx("c")}) as v from (select axis, b, r, sum(c) as c from po group by axis, b, r) group by axis, b),
dp as (select axis, b, 1 as j, t, v from sg where s = 0
       union all select dp.axis, dp.b, dp.j + 1, sg.t, max(dp.v + sg.v) from dp join sg on sg.axis = dp.axis and sg.b = dp.b and sg.s = dp.t
         join nu on nu.axis = dp.axis and nu.b = dp.b and dp.j < nu.most group by dp.axis, dp.b, dp.j, sg.t),
sc as (select nu.axis, j as bins, nu.b as levels, (max(best) over (partition by nu.axis, nu.b order by j) - rw.v + n * ln(n)) / n / ln(least(j, nu.b)) as score
       from nu join (select axis, b, unnest(range(1, most + 1)) as j from nu) using (axis, b) join rw using (axis, b)
       left join (select dp.axis, dp.b, dp.j, dp.v as best from dp join nu on nu.axis = dp.axis and nu.b = dp.b and nu.k = dp.t) e using (axis, b, j))"""

FIELD_VALUES = "{base} select u as \"user\", f as field_id, round({agg}, 6) as value from obs group by u, f"

def zero_shares(tree: str, one_hot: str) -> str:
    """Share blocks over ranges from 0 on, with only zeros for every third user; what stands for a zero total."""

    def own(k: int, where: str) -> str:
        return f"""(select w.u, w.f, greatest(0.0, least(hi, case when w.u % 3 = 0 then 0.0 else w.x end)) as x
          from {window("avg(v)", k)} w join st s on s.f = w.f where {where})"""

    def shares_of(rows: str, fields: str) -> str:
        return f"""select u, idx, x, tot from (select u, f, x, sum(x) over (partition by u) as tot from {rows}) q join {fields} c on c.f = q.f"""

    detail = shares_of(own(3, GROUPS["query_detail"].replace("f ", "w.f ")), rate("query_detail"))
    every_field = shares_of(own(6, "w.f in (select f from cata)"), "cata")
    best_three = f"(select u, f, x from (select u, f, x, row_number() over (partition by u order by x desc, f) as rn from {own(0, 'w.f in (select f from cata)')}) where rn <= 3)"
    share = "x / tot"

    def hot(name: str, rows: str) -> str:
        return f"""select '{name}' as block, u as "user", cast(idx * 5 + bin as int) as idx, 1.0::double as value
          from (select u, idx, case when tot = 0 then {one_hot} else {bins(share)} end as bin from ({rows})) where bin is not null"""

    return f"""{FULL} select * from (
      select 'tree_rate' as block, u as "user", cast(idx as int) as idx,
             case when tot = 0 then {tree}::double else round({share}, 6) end as value from ({detail})) where value is not null
      union all {hot("onehot_rate", every_field)} union all {hot("onehot_topn_rate", shares_of(best_three, "cata"))}"""


def together(layouts: dict[str, list[tuple[str, str]]]) -> str:
    """The rows of several layouts, one after the other."""
    parts = []
    for name, blocks in layouts.items():
        own, at = [], "1"
        for triples, width in blocks:
            own.append(f"select u, {at} + idx as idx, value from ({triples})")
            at = f"{at} + {width}"
        parts.append(f"select '{name}' as layout, cast({at} - 1 as int) as feature_size, u, idx, value from ({' union all '.join(own)})")
    return f"""{FULL}, {CODES} select layout, users.u as "user", label, feature_size, cast(idx as int) as idx, round(value, 6) as value
      from ({" union all ".join(parts)}) b join users on users.u = b.u where users.u not in (select u from outu)"""


# Ranges from 0 on and only zeros for every third user: observations and ranges under their usual names.
ZERO_OBS = OBS.replace("obs as (", "seen as (", 1) + f""",
obs as (select u, label, dist, f, case when u % 3 = 0 and f not in {CATEGORY} then 0.0 else v end as v from seen)"""


def keeping_nan(k: int) -> str:
    """A window layout in which shares of a zero total are -1. Lists come from the observations as they were."""
    lists = LISTS.replace(" from obs", " from seen").replace("st as (", "st0 as (").replace("cs as (", "st as (select f, 0.0 as lo, hi from st0), cs as (")
    blocks = [(t.replace("x / tot as value", "case when tot = 0 then -1.0 else x / tot end as value").replace("where tot <> 0", ""), w) for t, w in window_blocks(k, "cata", "catm")]
    text = laid_out(blocks)
    return text.replace(FULL, f"with {USERS}, {ZERO_OBS}, {lists}", 1)


SPARSE = f"""{layout(window_blocks(6, "cata", "catm"))}, sparse as (
        select "user", feature_size, label || ' ' || string_agg(idx || ':' || {TEXT}, ' ' order by idx) as features
        from laid where abs(value) > 0.0001 group by "user", label, feature_size)"""

def boosted(rows: float, columns: float, weight: float, least: int, l2: float, levels: int, held_out: bool = False) -> str:
    """CTEs of the first boosted tree, grown level by level, as all of its leaves fit: ``asg(u, label, trained, drawn, path)``, ``spl`` and ``edg``.

    Gradients are multiples of a half, so all sums are exact.
    """

    def share(*parts: str) -> str:
        return f"('0x' || substr(md5({" || '#' || ".join(parts)}), 1, 8))::bigint::double / 4294967296"

    train = f"('0x' || substr(md5(u || '#0'), 1, 8))::bigint % 10 <> 0" if held_out else "true"
    sql = f"""{layout(window_blocks(9, "cata", "catm"))},
      us as materialized (select distinct u, label, {train} as trained, {train} and {share("u", "'row'", "'0'", "'0'")} < {rows} as drawn from (select "user" as u, * from laid)),
      tok as materialized (select "user" as u, idx - 1 as f, cast({TEXT} as double) as v from laid where abs(value) > 0.0001),
      ctr as (select f, v, count(*) as n from tok join us using (u) where trained group by f, v),
      tot as (select count(*) as n from us where trained),
      cnt as (select f, v, n from ctr where v <> 0 union all select f, 0.0, (select n from tot) - sum(n) from ctr where v <> 0 group by f),
      plc as (select f, v, coalesce(sum(n) over (partition by f order by v rows between unbounded preceding and 1 preceding), 0) * 255 // (select n from tot) as c from cnt),
      cod as materialized (select f, v, (c - max(case when v = 0 then c end) over (partition by f))::int as c from plc),
      edg as (select f, c, max(v) as upto from cod group by f, c),
      den as materialized (select u, f, coalesce(c, 0) as c, coalesce(v, 0) as v from us cross join (select distinct f from cod where {share("f", "'column'", "'0'", "'0'")} < {columns}) left join tok using (u, f) left join cod using (f, v)),
      asg0 as materialized (select u, label, trained, drawn, '' as path from us)"""
    for k in range(levels):
        sql += f""",
      tot{k} as (select path, sum(0.5::double - label) as ag, count(*) * 0.25::double as ah, count(*) as an from asg{k} where drawn group by path),
      his{k} as (select path, f, c, sum(0.5::double - label) as g, count(*) * 0.25::double as h, count(*) as n from asg{k} join den using (u) where drawn group by path, f, c),
      cum{k} as (select path, f, c, sum(g) over w as g, sum(h) over w as h, sum(n) over w as n from his{k} window w as (partition by path, f order by c)),
      can{k} as (select path, f, c, ag, ah, an, g * g / (h + {l2}) + (ag - g) * (ag - g) / (ah - h + {l2}) - ag * ag / (ah + {l2}) as gain
        from cum{k} join tot{k} using (path) where n >= {least} and an - n >= {least} and h >= {weight} and ah - h >= {weight}),
      bst{k} as materialized (select * from (select *, row_number() over (partition by path order by gain desc, f, c) as rn from can{k} where gain > 0) where rn = 1),
      asg{k + 1} as materialized (select u, label, trained, drawn, a.path || case when d.v <= e.upto then 'L' else 'R' end as path
        from asg{k} a join bst{k} b using (path) join edg e using (f, c) join den d using (u, f))"""
    ends = " union all ".join(f"select u, label, trained, drawn, path from asg{k} anti join bst{k} using (path)" for k in range(levels))
    splits = " union all ".join(f"select * from bst{k}" for k in range(levels))
    return f"""{sql},
      asg as materialized ({ends} union all select u, label, trained, drawn, path from asg{levels}), spl as materialized ({splits}),
      lvs as (select path, -0.025::double * sum(0.5::double - label) / (count(*) * 0.25::double + {l2}) as value, count(*)::double as cover from asg where drawn group by path)"""


# The settings of the two learners. With at least 50 rows a leaf, depth 30 is out of reach here.
BY_LEAF, BY_DEPTH = (0.8, 0.8, 5.0, 50, 0.0, 30), (0.78, 0.76, 2.32, 1, 9.0, 5)
NODES = """
      select path, (f + 1)::int as feature_idx, upto as threshold, round(gain, 6) as gain, an::double as cover, null::double as value from spl join edg using (f, c)
      union all select path, null, null, null, cover, round(value, 9) from lvs"""

ORACLES: dict[str, str] = {
    "labels_file": f'{BASE} select cast(u as varchar) as "user", {month("lm")} as label_month, label from users',
    "profiles_file": f'{BASE} select cast(u as varchar) as "user", cast(dist as int) as dist, f as field_id, v as value from obs',
    "catalogue_file": f"{FULL} select f as field_id, cast(idx as int) as idx from cata",
    "field_set_file": f"{FULL} select f as field_id from catm",
    "pairs_file": f"{FULL} select l as left_id, r as right_id, cast(idx as int) as idx from pr",
    "pair_members_file": f"{FULL} select l as field_id from pr union select r from pr",
    "users_file": f'{FULL} select cast(u as varchar) as "user" from outu',
    "minmax_file": f"{FULL} select f as field_id, lo, hi from st",
    "varying_file": f"{FULL} select f as field_id, lo, hi from cs",
    "importance_file": f"""{FULL} select cast(idx as int) as feature_idx, users::double as score, form
        from beh join fu using (f), (select unnest(['comma', 'tab']) as form)""",
    "predictions_file": f"{BASE} select u as user_id, round(s, 6) as ovd_rate from {predictions(37, 101)}",
    "column_presence_file": f"""{FULL}, have as (select f, count(distinct u) as h from obs where {PRESENT} group by f)
        select cast(i as int) as field_id, printf('%.4f', coalesce(h, 0)::double / n) as presence
        from (select unnest(range(1, 96117)) as i), nu left join have on f = i where coalesce(h, 0) < n""",
    "row_presence_file": f"""{BASE} select users.u as "user",
        printf('%.4f', count(distinct case when {PRESENT} then f end)::double / 96116) as presence
        from users left join obs on obs.u = users.u group by users.u""",
    "encoded_file": f'{SPARSE} select "user", feature_size, features, true as in_order from sparse',
    "encoded_round_trip": f'''{SPARSE} select "user", label, feature_size, idx, cast({TEXT} as double) as value
        from laid where abs(value) > 0.0001''',
    "svm_lines": f'{SPARSE} select "user", features as line from sparse',
    "month_distance": """select o_orderkey, strftime(o_orderdate, '%Y-%m') as month,
        cast((1999 - year(o_orderdate)) * 12 + 1 - month(o_orderdate) as int) as distance,
        strftime(date_trunc('month', o_orderdate) - to_months(cast(o_orderkey % 12 + 1 as int)), '%Y-%m') as before from orders""",
    "window_counts": f"""{BASE} select u as "user", {", ".join(f"count(*) filter (dist <= {12 - k}) as n{k}" for k in (0, 3, 6, 9))}
        from obs group by u""",
    "parse_actions": f"""{BASE} select cast(obs.u as varchar) as "user", {month("lm - dist")} as action_month, f as field_id,
        case when f = min(f) over w then cast(count(*) over w as double) else v end as value
        from obs join users on users.u = obs.u window w as (partition by obs.u, dist)""",
    "actions_file": f"""{BASE} select cast(obs.u as varchar) as "user", {month("lm - dist")} as action_month, f as field_id,
        case when f = min(f) over w then cast(count(*) over w as double) else v end as value
        from obs join users on users.u = obs.u window w as (partition by obs.u, dist)""",
    "merge_training": f"""{BASE} select cast(u as varchar) as "user", cast(dist as int) as dist, f as field_id,
        case when f = min(f) over w then cast(count(*) over w as double) else v end as value
        from obs window w as (partition by u, dist)""",
    "merge_scoring": f"""{BASE} select cast(obs.u as varchar) as "user", '1998-08' as label_month, 0 as label,
        cast(1998 * 12 + 8 - (lm - dist) as int) as dist, f as field_id,
        case when f = min(f) over w then cast(count(*) over w as double) else v end as value
        from obs join users on users.u = obs.u
        where 1998 * 12 + 8 - (lm - dist) <= 12 window w as (partition by obs.u, dist)""",
    "merge_profile_months": f"""{BASE}, spine as (
        select u, lm, label, unnest(range(1, 13)) as dist from users
        union select obs.u, lm, users.label, dist from obs join users on users.u = obs.u)
        select s.u as "user", {month("lm")} as time, s.label, {month("lm - s.dist")} as month,
               cast(count(f) as int) as n, coalesce(sum(v), 0.0) as total
        from spine s left join obs on obs.u = s.u and obs.dist = s.dist group by s.u, lm, s.label, s.dist""",
    "profile_round_trip": f"""{BASE} select u as "user", cast(dist as int) as dist, f as field_id, v as value from obs""",
    "field_avg": FIELD_VALUES.format(base=BASE, agg="avg(v)"),
    "field_max": FIELD_VALUES.format(base=BASE, agg="max(v)"),
    "field_min": FIELD_VALUES.format(base=BASE, agg="min(v)"),
    "field_max_change": FIELD_VALUES.format(base=BASE, agg=CHANGE),
    "minmax_stats": f"{FULL} select f as field_id, lo, hi from st",
    "max_change_stats": f'{BASE} select f as field_id, lo, hi from ({_positions("(select u, f, max(v) - min(v) as x from obs group by u, f)")})',
    "varying_change_stats": f"{FULL} select f as field_id, lo, hi from cs",
    "column_presence": f"""{FULL}, have as (select f, count(distinct u) as h from obs where {PRESENT} group by f)
        select cast(i as int) as field_id, n - coalesce(h, 0) as missing, round(coalesce(h, 0)::double / n, 6) as presence
        from (select unnest(range(1, 96117)) as i), nu left join have on f = i where coalesce(h, 0) < n""",
    "row_presence": f"""{BASE} select users.u as "user",
        round(count(distinct case when {PRESENT} then f end)::double / 96116, 9) as presence
        from users left join obs on obs.u = users.u group by users.u""",
    "category_rate": f"""{BASE} select value, round(avg(label), 6) as rate from (
        select obs.u, users.label, first(v order by dist) as value from obs join users on users.u = obs.u
        where f = 4 group by obs.u, users.label) where value >= 0 group by value""",
    "category_values": f"{BASE} select distinct v as value from obs where f = 19",
    "presence_windows": f"""{BASE} select f as field_id, k as "window", count(distinct u) as have
        from obs, (select unnest([0, 3, 6, 9])::int as k) where {PRESENT} and dist <= 12 - k group by f, k""",
    "missing_windows": f"""{BASE} select users.u as "user", {", ".join(f"5000 - count(distinct case when {PRESENT} and dist <= {12 - k} then f end) as missing{k}" for k in (0, 3, 6, 9))}
        from users left join obs on obs.u = users.u group by users.u""",
    "months_merged": f"""{BASE} select cast(u as varchar) as "user", cast(dist as int) as dist, f as field_id,
        case when f = min(f) over w then cast(count(*) over w as double) else v end as value
        from obs window w as (partition by u, dist)""",
    "months_window": f"""{BASE} select cast(u as varchar) as "user", f as field_id, round(avg(x), 6) as avg, round(max(x), 6) as max, round(min(x), 6) as min, round(max(x) - min(x), 6) as change
        from (select u, dist, f, case when f = min(f) over w then cast(count(*) over w as double) else v end as x from obs window w as (partition by u, dist))
        where dist <= 6 group by u, f""",
    "tree_block_avg": block(values("avg(v)", 0, "cata")),
    "tree_block_max": block(values("max(v)", 6, "catm")),
    "tree_rate": block(shares(3, GROUPS["query_detail"].replace("f ", "t.f "), rate("query_detail"))),
    "tree_log_pair": block(pairs(0, "pr", "x", LOG)),
    "tree_max_change": block(changes(0, "cata")),
    "onehot_block": block(onehot_values("avg(v)", 6, "cata")),
    "onehot_rate": block(binned(shares(6, "t.f in (select f from cata)", "cata"))),
    "onehot_topn_rate": block(
        binned(
            f"""select u, idx, x / tot as value from (
              select u, f, x, sum(x) over (partition by u) as tot from (
                select t.u, t.f, x, row_number() over (partition by t.u order by x desc, t.f) as rn
                from {trimmed("avg(v)", 0)} t where t.f in (select f from cata)) where rn <= 3) q
              join cata c on c.f = q.f where tot <> 0"""
        )
    ),
    "zero_shares_keep": zero_shares("-1.0", "4"),
    "zero_shares_drop": zero_shares("null", "null"),
    "onehot_log_pair": block(binned(pairs(6, "pr", scale("x"), LOG))),
    "onehot_ratio_pair": block(
        binned(f"select u, idx, value / (1 + abs(value)) as value from ({pairs(0, 'rpr', scale('x'), RATIO)})")
    ),
    "onehot_max_change": block(onehot_values(CHANGE, 6, "cata", stats="cs")),
    "missing_count": block(missing_value(0)),
    "missing_onehot": block(missing_bin(6)),
    "missing_one_month": f"""{BASE} select u as "user", cast(dist as int) as dist,
        round((5000 - count(*) filter (f not in {CATEGORY}) - 10) / 4990.0::double, 6) as value from obs group by u, dist""",
    "profile_onehot": block(profile()),
    "profile_numeric": block(profile_numbers()),
    "catalog_candidates": f"""{FULL} select cast(i as int) as field_id, cast(row_number() over (order by i) - 1 as int) as idx
        from (select unnest(range(1, 96117)) as i)
        where i not in (select f from fu) or i in (select f from fu order by users desc, f limit 4)""",
    "pair_candidates": f"""{FULL} select a.f as left_id, b.f as right_id, row_number() over (order by a.f, b.f) - 1 as idx
        from cata a join cata b on a.f < b.f""",
    "ratio_pair_candidates": f"{FULL} select l as left_id, r as right_id, idx from rpr",
    "catalog_pairs_reindex": f"""{FULL} select l as left_id, r as right_id, cast(row_number() over (order by idx) - 1 as int) as idx from (
        select l, r, idx from pr join fu a on a.f = l join fu b on b.f = r order by a.users + b.users desc, idx limit 8)""",
    "catalog_pairs_by_number": f"""{FULL} select l as left_id, r as right_id, cast(row_number() over (order by idx) - 1 as int) as idx
        from (select a.f as l, b.f as r, row_number() over (order by a.f, b.f) - 1 as idx from beh a join beh b on a.f < b.f)
        where idx in (select idx * idx * 3 from beh)""",
    "catalog_ratio_pairs_by_number": f"""{FULL}, p as (select a.f as l, b.f as r, row_number() over (order by a.f, b.f) - 1 as idx from beh a join beh b on a.f < b.f)
        select l as left_id, r as right_id, cast(row_number() over (order by idx) - 1 as int) as idx
        from (select l, r, 2 * idx as idx from p union all select r, l, 2 * idx + 1 from p) where idx in (select idx * idx * 3 from beh)""",
    "catalog_reindex": numbered("(select f from fu order by users desc, f limit 10)"),
    "catalog_shifted": numbered("(select f from beh where idx % 2 = 1)"),
    "field_medians": f"""{FULL} select f as field_id, users::double as score, round(m, 6) as median from (
        select f, median(x) as m from (select u, f, avg(v) as x from obs group by u, f) group by f)
        join (select f, users from fu order by users desc, f limit 100) using (f)""",
    "catalog_split_unbounded": f"""{FULL} select f as field_id, cast(row_number() over (order by f) - 1 as int) as idx, 'avg' as half from beh where idx < 8
        union all select f, cast(row_number() over (order by f) - 1 as int), 'max' from beh where idx % 2 = 0""",
    "catalog_every_fourth": numbered("(select f from beh where idx % 4 = 2)"),
    "catalog_continuous": numbered("fu"),
    "catalog_split_halves": f"""{FULL} select f as field_id, cast(idx as int) as idx, 'avg' as half from cata
        union all select f, cast(idx as int), 'max' from catm""",
    "catalog_rates": f"""{FULL} select f as field_id, cast(row_number() over (order by f) - 1 as int) as idx from (
        select f from fu where f between 131 and 96048 or {GROUPS["app_install"]}
        union all select f + 1 from fu where {GROUPS["app_install"]} and f + 1 in (select f from fu))""",
    "catalog_by_group": f'{FULL} select g as "group", f as field_id, cast(idx as int) as idx from grp',
    "exclude_users": f"""{FULL} select u as "user", {month("lm")} as label_month, label from users
        where not exists (select 1 from outu where outu.u = users.u)""",
    "layouts_together": together(
        {
            "full_year": window_blocks(0, "cata", "cata"),
            "three_seasons": window_blocks(3, "cata", "catm"),
            "half_year": window_blocks(6, "cata", "catm"),
            "one_season": window_blocks(9, "cata", "catm"),
            "year_and_half": YEAR_AND_HALF,
        }
    ),
    "layouts_keeping_nan": keeping_nan(6),
    "layout_full_year": laid_out(window_blocks(0, "cata", "cata")),
    "layout_three_seasons": laid_out(window_blocks(3, "cata", "catm")),
    "layout_half_year": laid_out(window_blocks(6, "cata", "catm")),
    "layout_one_season": laid_out(window_blocks(9, "cata", "catm")),
    "layout_year_and_half": laid_out(YEAR_AND_HALF),
    "layout_linear": laid_out(LINEAR, excluding=False),
    "sparse_row_text": f"""{layout(window_blocks(6, "cata", "catm"))}
        select "user", feature_size, label || ' ' || string_agg(idx || ':' || {TEXT}, ' ' order by idx) as features
        from laid where abs(value) > 0.0001 group by "user", label, feature_size""",
    "dense_csv_row": f"""{layout(window_blocks(9, "cata", "catm"))},
        us as (select distinct "user", feature_size from laid),
        cells as (select us."user", us.feature_size, i from us, (select unnest(range(1, 1 + (select max(feature_size) from us))) as i) where i <= us.feature_size)
        select c."user", c.feature_size, string_agg(case when value is null then '0' else {DENSE} end, ',' order by i) as features
        from cells c left join (select "user", idx, value from laid where abs(value) > 0.0001) l on l."user" = c."user" and l.idx = c.i
        group by c."user", c.feature_size""",
    "blend_scores": f"""{BASE} select a.u as user_id, round(0.25 * a.s + 0.25 * b.s + 0.25 * c.s + 0.25 * d.s, 6) as ovd_rate
        from {predictions(31, 101)} a join {predictions(37, 101)} b on b.u = a.u
        join {predictions(43, 101)} c on c.u = a.u join {predictions(49, 101)} d on d.u = a.u""",
    "blend_models": f"""{BASE} select a.u as user_id, round(0.2 * a.s + 0.8 * b.s, 6) as ovd_rate
        from {predictions(37, 101)} a join {predictions(53, 97)} b on b.u = a.u""",
    "auc": f"""{BASE}, r as (
        select label, rank() over (order by s) + (count(*) over (partition by s) - 1) / 2.0 as rk from {predictions(37, 101)})
        select round((sum(rk) filter (label = 1) - p * (p + 1) / 2.0) / (p * (n - p)), 6)::double as auc
        from r, (select sum(label)::double as p, count(*)::double as n from users) group by p, n""",
    "grid_scores": f"{GRID} select a, b, round(score, 6) as score from sc",
    "optimised_grids": f"{CUTS} select axis, bins, levels, round(score, 6) as score from sc where bins > 1",
    "grid_association": f"{CUTS} select round(coalesce(max(score), 0.0), 6) as association from sc where bins > 1",
    "correlation": f"""{BASE} select round(corr(a.s, b.s), 6) as correlation
        from {predictions(1, 101)} a join {predictions(1, 211)} b on b.u = a.u""",
    "gbt_rounds": f"""{FULL} select count(*) as scored, count(*) as users, true as in_range, 1.0::double as importance, 20 as trees
        from users where u not in (select u from outu)""",
    "gbt_nodes": f"""{FULL} select count(*) as users, true as same_scores, 20::bigint as trees, true as binary, true as counted
        from users where u not in (select u from outu)""",
    "boosted_tree": boosted(*BY_LEAF) + NODES,
    "boosted_tree_by_depth": boosted(*BY_DEPTH) + NODES,
    "boosted_importance": f"{boosted(*BY_LEAF)} select (f + 1)::int as feature_idx, count(*) as splits, round(sum(gain), 6) as gain from spl group by f",
    "boosted_scores": f"{boosted(*BY_LEAF)} select u as user_id, round(1 / (1 + exp(-value)), 6) as ovd_rate from asg join lvs using (path)",
    "validation_error": f"""{boosted(*BY_LEAF, held_out=True)} select 1 as round, round(avg(ln(1 + exp(case when label = 1 then -value else value end))), 6) as log_loss
        from asg join lvs using (path) where not trained""",
    "holdout_parts": f"""{BASE} select count(*) as users, 1::bigint as most, count(distinct label)::int as labels_held, true as about_a_tenth
        from users""",
    "holdout_sample": f"""{BASE} select u as "user", label, case when rn <= ceil(n::double * 0.1::double) then 'validate' else 'train' end as part
        from (select u, label, row_number() over (partition by label order by md5(u || '#0'), u) as rn, count(*) over (partition by label) as n from users)""",
    "holdout_split": f"""{BASE} select u as "user", label,
        ('0x' || substr(md5(u || '#0'), 1, 8))::bigint % 10 = 0 as is_validation from users""",
}
