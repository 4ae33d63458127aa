"""SQL of the additive model for comparison: the same sums, solved by elimination."""

from __future__ import annotations

from .operators.additive import RIDGE


def basis_sql(designs: str, table: str, y: str, smooths: tuple[str, ...], linear: tuple[str, ...] = (), fold: str = "0") -> str:
    """Tables `entries` (id, n, fold, i, v) and `sums` (n, fold, i, j, v) over `table` for each n of the table `designs`."""
    k, m = len(smooths), len(linear)
    ends = ", ".join(f"MIN({c})::DOUBLE AS a{s}, MAX({c})::DOUBLE AS b{s}" for s, c in enumerate(smooths))
    at = ", ".join(f"greatest(0.0::DOUBLE, least((n - 3 - 1e-9)::DOUBLE, ({c} - a{s}) / ((b{s} - a{s}) / (n - 3)))) AS t{s}" for s, c in enumerate(smooths))
    cells = ", ".join(f"floor(t{s})::INT AS f{s}, t{s} - floor(t{s}) AS u{s}" for s in range(k))
    values = ["{i: 0, v: 1.0::DOUBLE}"]
    for s in range(k):
        u = f"u{s}"
        for o, v in enumerate((f"(1 - {u}) * (1 - {u}) * (1 - {u})", f"3 * {u} * {u} * {u} - 6 * {u} * {u} + 4", f"-3 * {u} * {u} * {u} + 3 * {u} * {u} + 3 * {u} + 1", f"{u} * {u} * {u}")):
            values.append(f"{{i: 1 + {s} * n + f{s} + {o}, v: (({v}) / 6)::DOUBLE}}")
    values += [f"{{i: 1 + {k} * n + {p}, v: {c}::DOUBLE}}" for p, c in enumerate(linear)]
    values.append(f"{{i: 1 + {k} * n + {m}, v: {y}::DOUBLE}}")
    return f"""ends AS (SELECT {ends} FROM {table}),
placed AS (SELECT *, row_number() OVER () AS id, ({fold})::INT AS fold, {at} FROM {table}, ends, {designs}),
entries AS (SELECT id, n, fold, x.i AS i, x.v AS v FROM (SELECT id, n, fold, unnest([{", ".join(values)}]) AS x FROM (SELECT *, {cells} FROM placed))),
sums AS (SELECT a.n, a.fold, a.i, b.i AS j, SUM(a.v * b.v) AS v FROM entries a JOIN entries b ON a.id = b.id AND a.n = b.n GROUP BY ALL)"""


def solution_sql(smooths: int, linear: int = 0, ridge: float = RIDGE) -> str:
    """Table `weights` (n, penalty, fold, b) from `systems` (n, penalty, fold, i, j, v), by elimination without pivots."""
    size = f"(1 + {smooths} * n + {linear})"
    return f"""bend AS (SELECT n, p.x + q.x AS i, p.x + r.x AS j, SUM(q.c * r.c) AS v FROM (SELECT DISTINCT n FROM systems), (SELECT unnest(range(1000)) AS x) p, (VALUES (0, 1), (1, -2), (2, 1)) q(x, c), (VALUES (0, 1), (1, -2), (2, 1)) r(x, c) WHERE p.x < n - 2 GROUP BY ALL),
stiff AS (SELECT n, 1 + s * n + i AS i, 1 + s * n + j AS j, v::DOUBLE AS v FROM bend, range({smooths}) t(s)),
keys AS (SELECT DISTINCT n, penalty, fold FROM systems),
cells AS (SELECT k.n, penalty, fold, x.i, y.j FROM keys k, (SELECT unnest(range(1000)) AS i) x, (SELECT unnest(range(1000)) AS j) y WHERE x.i < {size} AND y.j <= {size}),
filled AS (SELECT c.n, c.penalty, c.fold, c.i, c.j, coalesce(s.v, 0) + coalesce(c.penalty * w.v, 0) + CASE WHEN c.i = c.j AND c.i BETWEEN 1 AND {smooths} * c.n THEN {ridge} ELSE 0 END AS v
    FROM cells c LEFT JOIN systems s ON s.n = c.n AND s.penalty = c.penalty AND s.fold = c.fold AND s.i = c.i AND s.j = c.j LEFT JOIN stiff w ON w.n = c.n AND w.i = c.i AND w.j = c.j),
matrices AS (SELECT n, penalty, fold, list(r ORDER BY i) AS m FROM (SELECT n, penalty, fold, i, list(v ORDER BY j) AS r FROM filled GROUP BY ALL) GROUP BY ALL),
steps AS (SELECT n, penalty, fold, 1 AS k, m FROM matrices UNION ALL
    SELECT n, penalty, fold, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda x: x / m[k][k]) ELSE list_transform(r, lambda x, j: x - r[k] * m[k][j] / m[k][k]) END) FROM steps WHERE k <= {size}),
weights AS (SELECT n, penalty, fold, list_transform(m, lambda r: r[{size} + 1]) AS b FROM steps WHERE k = {size} + 1)"""
