"""SQL twin of the epoch-wise training: every step of a small network as a chain of plain queries.

Needs the tables ``nx`` (rid, j, v: the inputs that are not zero) and ``ny`` (rid, role, batch and the
label columns). Defines ``hist`` (one row per epoch) and, for the last weights, ``p_<head>`` (rid, c, p).
"""

from __future__ import annotations

import math

from kiln.operators.training import CLIP, EPSILON, RHO, Network, batch_order


def training_sql(net: Network, epochs: int, batches: int, rate: float, rmsprop: bool) -> str:
    out, n = [], len(net.hidden)

    def add(name: str, sql: str) -> str:
        out.append(f"{name} AS MATERIALIZED ({sql})")
        return name

    def forward(tag: str, rows: str, w: dict[str, str]) -> list[str]:
        """Adds the layers' inputs and outputs of some rows; returns the tables of the layers' inputs."""
        layers = [add(f"{tag}_x", f"SELECT nx.rid, nx.j, nx.v FROM nx JOIN {rows} r ON nx.rid = r.rid")]
        product = lambda x, name: (f"SELECT r.rid, b.k, b.v + coalesce(s.s, 0) AS z FROM {rows} r CROSS JOIN {w['b' + name]} b LEFT JOIN "  # noqa: E731
                                   f"(SELECT x.rid, w.k, sum(x.v * w.v) AS s FROM {x} x JOIN {w['w' + name]} w ON x.j = w.j GROUP BY x.rid, w.k) s "
                                   "ON s.rid = r.rid AND s.k = b.k")
        for i in range(n):
            layers.append(add(f"{tag}_h{i}", f"SELECT rid, k AS j, greatest(z, 0) AS v FROM ({product(layers[-1], str(i))})"))
        for h in net.heads:
            z = product(layers[-1], f"_{h.name}")
            if h.kind == "classes":
                add(f"{tag}_p_{h.name}", f"SELECT rid, k AS c, exp(z - m) / sum(exp(z - m)) OVER (PARTITION BY rid) AS p FROM "
                                         f"(SELECT *, max(z) OVER (PARTITION BY rid) AS m FROM ({z}))")
            else:
                add(f"{tag}_p_{h.name}", f"SELECT rid, k AS c, 1 / (1 + exp(-z)) AS p FROM ({z})")
            y, p = f"y.{h.label}", f"least(greatest(p, {CLIP}), 1 - {CLIP})"
            if h.kind == "classes":
                one = f"SELECT rid, -ln(max(CASE WHEN c = y THEN {p} END)) AS loss, CAST(arg_max(c, p) = any_value(y) AS DOUBLE) AS metric"
            elif h.kind == "binary":
                one = f"SELECT rid, any_value(-(y * ln({p}) + (1 - y) * ln(1 - {p}))) AS loss, any_value(CAST((p > 0.5) = (y > 0.5) AS DOUBLE)) AS metric"
            else:
                one = "SELECT rid, any_value((p - y) ** 2) AS loss, any_value(abs(p - y)) AS metric"
            add(f"{tag}_e_{h.name}", f"SELECT count(*) AS n, sum(loss) AS loss, sum(metric) AS metric FROM ({one} FROM "
                                     f"(SELECT q.rid, q.c, q.p, {y} AS y FROM {tag}_p_{h.name} q JOIN ny y ON q.rid = y.rid WHERE {y} IS NOT NULL) GROUP BY rid)")
        return layers

    weights, state = {}, {}
    for layer, (name, shape) in enumerate(net.shapes().items()):
        if len(shape) == 1:
            weights[name] = add(f"s0_{name}", f"SELECT 0 AS j, k, 0.0::DOUBLE AS v FROM range({shape[0]}) t(k)")
        else:
            size = 2 * math.sqrt(6 / (shape[0] + shape[1]))
            weights[name] = add(f"s0_{name}", f"SELECT j, k, (((j * 7919 + k * 104729 + {layer * 1299709 + net.seed * 15485863}) % 1000003)::DOUBLE / 1000003 - 0.5) "
                                              f"* {size!r} AS v FROM range({shape[0]}) a(j), range({shape[1]}) b(k)")
        state[name] = add(f"v0_{name}", f"SELECT j, k, 0.0::DOUBLE AS v FROM {weights[name]}")
    rows_of = [add(f"rows_{b}", f"SELECT rid FROM ny WHERE role = 'train' AND batch = {b}") for b in range(batches)]
    add("rows_val", "SELECT rid FROM ny WHERE role = 'val'")
    history, step = [], 0
    for epoch in range(1, epochs + 1):
        tags = []
        for b in batch_order(epoch, batches, net.seed):
            step += 1
            t = f"t{step}"
            tags.append(t)
            layers = forward(t, rows_of[b], weights)
            grads: dict[str, list[str]] = {name: [] for name in weights}
            for h in net.heads:
                y = f"y.{h.label}"
                d = {"classes": f"(p - CASE WHEN c = {y} THEN 1 ELSE 0 END)", "binary": f"(p - {y})", "unit": f"(2 * (p - {y}) * p * (1 - p))"}[h.kind]
                dz = add(f"{t}_d_{h.name}", f"SELECT q.rid, q.c AS k, {d} / (SELECT greatest(n, 1) FROM {t}_e_{h.name}) AS d "
                                            f"FROM {t}_p_{h.name} q JOIN ny y ON q.rid = y.rid WHERE {y} IS NOT NULL")
                grad = lambda x, dz: f"SELECT x.j, d.k, sum(x.v * d.d) AS g FROM {x} x JOIN {dz} d ON x.rid = d.rid GROUP BY x.j, d.k"
                bias = lambda dz: f"SELECT 0 AS j, k, sum(d) AS g FROM {dz} GROUP BY k"
                grads[f"w_{h.name}"].append(grad(layers[-1], dz))
                grads[f"b_{h.name}"].append(bias(dz))
                above = weights[f"w_{h.name}"]
                for i in reversed(range(n)):
                    dz = add(f"{t}_d_{h.name}_{i}", f"SELECT a.rid, a.k, a.d FROM (SELECT d.rid, w.j AS k, sum(d.d * w.v) AS d FROM {dz} d JOIN {above} w ON d.k = w.k "
                                                    f"GROUP BY d.rid, w.j) a JOIN {layers[i + 1]} h ON h.rid = a.rid AND h.j = a.k WHERE h.v > 0")
                    grads[f"w{i}"].append(grad(layers[i], dz))
                    grads[f"b{i}"].append(bias(dz))
                    above = weights[f"w{i}"]
            for name, parts in grads.items():
                g = add(f"{t}_g_{name}", f"SELECT j, k, sum(g) AS g FROM ({' UNION ALL '.join(parts)}) GROUP BY j, k")
                old = weights[name]
                if rmsprop:
                    state[name] = add(f"v{step}_{name}", f"SELECT s.j, s.k, {RHO} * s.v + {1 - RHO!r} * coalesce(g.g, 0) ** 2 AS v FROM {state[name]} s "
                                                         f"LEFT JOIN {g} g ON g.j = s.j AND g.k = s.k")
                    weights[name] = add(f"s{step}_{name}", f"SELECT w.j, w.k, w.v - {rate} * (coalesce(g.g, 0) / (sqrt(s.v) + {EPSILON})) AS v FROM {old} w "
                                                           f"JOIN {state[name]} s ON s.j = w.j AND s.k = w.k LEFT JOIN {g} g ON g.j = w.j AND g.k = w.k")
                else:
                    weights[name] = add(f"s{step}_{name}", f"SELECT w.j, w.k, w.v - {rate} * coalesce(g.g, 0) AS v FROM {old} w LEFT JOIN {g} g ON g.j = w.j AND g.k = w.k")
        forward(f"val{epoch}", "rows_val", weights)
        cols = [f"{epoch} AS epoch"]
        for h in net.heads:
            both = " UNION ALL ".join(f"SELECT * FROM {t}_e_{h.name}" for t in tags)
            for m in ("loss", "metric"):
                cols.append(f"(SELECT sum({m}) / sum(n) FROM ({both})) AS {h.name}_{m}")
                cols.append(f"(SELECT {m} / n FROM val{epoch}_e_{h.name}) AS val_{h.name}_{m}")
        history.append("SELECT " + ", ".join(cols))
    add("hist", " UNION ALL ".join(history))
    add("rows_all", "SELECT rid FROM ny")
    forward("p_all", "rows_all", weights)
    for h in net.heads:
        add(f"p_{h.name}", f"SELECT * FROM p_all_p_{h.name}")
    return ",\n".join(out)
