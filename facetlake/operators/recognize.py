"""Engineering features by rules over face and edge records, with the evidence for each.

A part is one task's work: rules claim faces in a fixed order, so they cannot be split. What can be said face by face
(observations, confidences, labels) is plain column work outside the Python function.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetlake.functions.constants import FEATURE_LABELS, FEATURE_PREFIXES
from facetlake.schemas import FEATURES

ANGLE_DEG, LENGTH_MM, CAP = 2.0, 1e-3, 0.95
_COS, _SIN = math.cos(math.radians(ANGLE_DEG)), math.sin(math.radians(ANGLE_DEG))


# ---- column work


def span_rad() -> Column:
    """Swept angle of a cylinder, or of a torus's small circle."""
    uv = F.col("uv_bounds")
    return F.when(F.col("surface_type") == "cylinder", uv[1] - uv[0]).when(F.col("surface_type") == "torus", uv[3] - uv[2]).otherwise(0.0)


def material_side() -> Column:
    h = F.col("curvature.mean_curvature_mean")
    return F.when(~F.col("surface_type").isin("cylinder", "cone", "sphere", "torus") | h.isNull(), "n/a").when(h < 0, "outside").otherwise("inside")


def observe(faces: DataFrame) -> DataFrame:
    """Measured facts of each face, one row a face."""
    p, kind = F.col("analytic_params"), F.col("surface_type")
    only = lambda k, c: F.when(kind == k, c)
    return faces.select("sample_id", "face_idx", "surface_type", material_side().alias("material_side"), "area_mm2", only("cylinder", p["radius"]).alias("radius_mm"), only("torus", p["major_radius"]).alias("major_radius_mm"), only("torus", p["minor_radius"]).alias("minor_radius_mm"), F.when(kind.isin("cylinder", "torus"), F.round(F.degrees(span_rad()), 4)).alias("span_deg"), F.when(kind.isin("cylinder", "torus"), material_side() == "outside").alias("concave"), only("cylinder", p["axis"]).alias("axis"), only("cylinder", p["axis_origin"]).alias("axis_origin"), only("plane", F.coalesce("normal_at_centroid", p["axis"])).alias("normal"))


def confidence(evidence: Column) -> Column:
    return F.round(CAP * F.size(F.filter(evidence, lambda e: e["passed"])) / F.greatest(F.size(evidence), F.lit(1)), 4)


def face_labels(features: DataFrame, faces: DataFrame) -> DataFrame:
    """(sample_id, face_idx, label): of several features the last by id order wins; planes without one are planar, the rest other."""
    label = F.create_map(*[F.lit(x) for pair in FEATURE_LABELS.items() for x in pair])
    order = F.array_position(F.array(*map(F.lit, FEATURE_LABELS)), F.col("feature_type"))
    named = features.select("sample_id", F.explode("face_indices").alias("face_idx"), label[F.col("feature_type")].alias("label"), F.struct(order, "feature_id").alias("at"))
    last = named.groupBy("sample_id", "face_idx").agg(F.max_by("label", "at").alias("label"))
    return faces.join(last, ["sample_id", "face_idx"], "left").select("sample_id", "face_idx", F.coalesce("label", F.when(F.col("surface_type") == "plane", "planar").otherwise("other")).alias("label"))


# ---- one part


def _vector(v) -> np.ndarray:  # noqa: ANN001
    return np.zeros(3) if v is None else np.array([v["x"], v["y"], v["z"]], float)


def _unit(v: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(v)
    return v / n if n else v


def along(a: np.ndarray, b: np.ndarray) -> bool:
    return abs(float(_unit(a) @ _unit(b))) >= _COS


def across(a: np.ndarray, b: np.ndarray) -> bool:
    return abs(float(_unit(a) @ _unit(b))) <= _SIN


class Surface:
    """A face with what the rules ask of it."""

    def __init__(self, r: dict):
        p = r["analytic_params"] or {}
        self.i, self.kind, self.edges = r["face_idx"], r["surface_type"], list(r["boundary_edges"])
        self.outer, self.near = list(r["outer_loop_edges"]), set(r["adjacent"])
        self.normal, self.low, self.high = _vector(r["normal_at_centroid"] or p.get("axis")), _vector(r["bbox_min_mm"]), _vector(r["bbox_max_mm"])
        self.centroid = _vector(r["centroid_mm"])
        self.radius, self.minor = p.get("radius"), p.get("minor_radius")
        self.axis, self.origin = _unit(_vector(p.get("axis"))), _vector(p.get("apex") or p.get("axis_origin"))
        uv = r["uv_bounds"] if r["uv_bounds"] is not None else [0.0] * 4
        self.span = uv[1] - uv[0] if self.kind == "cylinder" else uv[3] - uv[2] if self.kind == "torus" else 0.0
        h = (r["curvature"] or {}).get("mean_curvature_mean")
        self.concave = self.kind in ("cylinder", "cone", "sphere", "torus") and h is not None and h < 0

    def foot(self) -> np.ndarray:
        """The point of the axis that is closest to the coordinate origin."""
        return self.origin - (self.origin @ self.axis) * self.axis


class Solid:
    """A part's faces and edges, and the faces that features have claimed."""

    def __init__(self, faces: list[dict], edges: list[dict]):
        self.f = {r["face_idx"]: Surface(r) for r in sorted(faces, key=lambda r: r["face_idx"])}
        self.e = {r["edge_idx"]: r for r in edges}
        self.claimed: set[int] = set()
        points = [v for s in self.f.values() for v in (s.low, s.high)]
        self.diagonal = float(np.linalg.norm(np.max(points, 0) - np.min(points, 0))) if points else 0.0

    def free(self, kind: str) -> list[Surface]:
        return [s for s in self.f.values() if s.kind == kind and s.i not in self.claimed]

    def shared(self, a: int, b: int) -> list[dict]:
        return [self.e[k] for k in self.f[a].edges if b in self.e[k]["adjacent"]]

    def by(self, a: int, convexity: str) -> set[int]:
        """Faces that meet face ``a`` in an edge of this class."""
        return {j for k in self.f[a].edges if self.e[k]["convexity"] == convexity for j in self.e[k]["adjacent"] if j != a}

    def reach(self, start: set[int], ok, most: int = 10**9) -> set[int] | None:  # noqa: ANN001
        """Faces joined to ``start`` through faces that ``ok`` accepts; None as soon as one outside is refused with "stop" or there are too many."""
        found: set[int] = set()
        todo = sorted(start)
        while todo:
            i = todo.pop()
            if i in found:
                continue
            verdict = ok(i)
            if verdict == "stop" or (verdict and len(found) >= most):
                return None
            if verdict:
                found.add(i)
                todo += sorted(self.f[i].near - found)
        return found


def _evidence(*checks: tuple[str, bool, str]) -> list[dict]:
    return [{"check": c, "passed": bool(p), "detail": d} for c, p, d in checks]


def _feature(kind: str, faces, params: dict, evidence: list[dict]) -> dict:  # noqa: ANN001
    return {"type": kind, "faces": sorted(faces), "params": {k: float(v) for k, v in params.items()}, "evidence": evidence}


class Bore:
    """A full concave cylinder, of one face or several, and its rims."""

    def __init__(self, solid: Solid, faces: list[Surface]):
        self.solid, self.faces, self.ids = solid, faces, {s.i for s in faces}
        self.axis, self.foot, self.radius = faces[0].axis, faces[0].foot(), faces[0].radius
        rims: dict[int, list[dict]] = {}
        for s in faces:
            for k in s.edges:
                e = solid.e[k]
                if e["convexity"] != "seam" and not set(e["adjacent"]) <= self.ids:
                    rims.setdefault(round(float(_vector(e["start_mm"]) @ self.axis) / 0.01), []).append(e)
        self.rims = [rims[k] for k in sorted(rims)]

    def outside(self, rim: list[dict]) -> set[int]:
        return {j for e in rim for j in e["adjacent"]} - self.ids

    def closes(self, i: int) -> bool:
        """Whether a face is a flat across the axis or a cone around it."""
        s = self.solid.f[i]
        if s.kind == "plane":
            return along(s.normal, self.axis)
        off = s.origin - self.foot
        return s.kind == "cone" and along(s.axis, self.axis) and float(np.linalg.norm(off - (off @ self.axis) * self.axis)) < 1e-2

    def end(self, rim: list[dict], bore_of: dict[int, int]) -> tuple[str, set[int], int]:
        """(open, floor, step or other; the faces of it; the bore that a step leads to)."""
        kinds = {e["convexity"] for e in rim}
        if kinds <= {"convex", "smooth"}:
            return "open", set(), -1
        if kinds != {"concave"}:
            return "other", set(), -1
        others: set[int] = set()

        def ring(i: int):  # noqa: ANN202
            if i in self.ids:
                return False
            if i in bore_of:
                others.add(bore_of[i])
                return False
            return True if self.closes(i) else "stop"

        faces = self.solid.reach(self.outside(rim), ring, 9)
        if faces and len(others) == 1:
            allowed = self.ids | faces | {i for i, b in bore_of.items() if b in others}
            if all(self.solid.f[i].near <= allowed for i in faces):
                return "step", faces, others.pop()
        floor = self.solid.reach(self.outside(rim), lambda i: False if i in self.ids else self.closes(i) or "stop", 9)
        if floor and all(self.solid.f[i].near <= self.ids | floor for i in floor):
            return "floor", floor, -1
        return "other", set(), -1


def bores(solid: Solid) -> list[Bore]:
    """Concave cylinders by axis and radius (a face joins the first group that fits), in connected runs that go all the way round."""
    groups: list[list[Surface]] = []
    near = 10 * max(LENGTH_MM, 1e-4)
    for s in (s for s in solid.f.values() if s.kind == "cylinder" and s.concave):
        fit = next((g for g in groups if along(g[0].axis, s.axis) and np.linalg.norm(g[0].foot() - s.foot()) < near and abs(g[0].radius - s.radius) < near), None)
        groups.append([s]) if fit is None else fit.append(s)
    out = []
    for g in groups:
        left = {s.i for s in g}
        while left:
            run = solid.reach({min(left)}, lambda i, ids=frozenset(left): i in ids) or set()
            left -= run
            if abs(sum(solid.f[i].span for i in run) - 2 * math.pi) <= math.radians(ANGLE_DEG):
                out.append(Bore(solid, [solid.f[i] for i in sorted(run)]))
    return out


def holes(solid: Solid) -> Iterator[dict]:
    """Bores joined by steps are one hole; its ends that lead on nowhere decide whether it goes through."""
    found = bores(solid)
    bore_of = {i: k for k, b in enumerate(found) for i in b.ids}
    ends = [[b.end(r, bore_of) for r in b.rims] for b in found]
    stack = list(range(len(found)))

    def top(k: int) -> int:
        while stack[k] != k:
            k = stack[k]
        return k

    step_faces: set[int] = set()
    for k, own in enumerate(ends):
        for kind, faces, other in own:
            if kind == "step" and len(own) == 2 and len(ends[other]) == 2:
                step_faces |= faces
                a, b = sorted((top(k), top(other)))
                stack[b] = a
    through: list[dict] = []
    for head in sorted({top(k) for k in range(len(found))}):
        members = [k for k in range(len(found)) if top(k) == head]
        last = [(e, b, r) for k in members for e, b, r in zip(ends[k], [found[k]] * len(ends[k]), found[k].rims, strict=True) if not (e[0] == "step" and e[1] & step_faces) and not found[k].outside(r) & step_faces]
        main = min((found[k] for k in members), key=lambda b: b.radius)
        faces = {i for k in members for i in found[k].ids} | ({i for k in members for e in ends[k] if e[0] == "step" for i in e[1]} & step_faces)
        at = [float(_vector(e["start_mm"]) @ main.axis) for k in members for r in found[k].rims for e in r]
        length = max(at) - min(at) if at else 0.0
        params = {"diameter_mm": 2 * main.radius} | {f"counterbore_diameter_{n}_mm": 2 * r for n, r in enumerate(sorted({round(found[k].radius, 6) for k in members} - {round(main.radius, 6)}), 1)}
        kinds = sorted(e[0] for e, *_ in last)
        common = [("concave_cylinder", True, f"{len(members)} segment(s)"), ("full_turn", True, "360 degrees"), ("two_ends", len(last) == 2, f"{len(last)} end(s)")]
        if kinds == ["open", "open"]:
            new = _feature("through_hole", faces, params | {"length_mm": length}, _evidence(*common, ("both_ends_open", True, "convex rims")))
            same = next((t for t in through if round(t["params"]["diameter_mm"], 6) == round(new["params"]["diameter_mm"], 6) and along(t["axis"], main.axis) and float(np.linalg.norm(np.cross(main.foot - t["foot"], _unit(t["axis"])))) <= 1e-2), None)
            if same:  # one drill through several walls
                same["faces"] = sorted({*same["faces"], *faces})
                same["params"]["length_mm"] += length
            else:
                through.append(new | {"axis": main.axis, "foot": main.foot})
                yield through[-1]
        elif kinds == ["floor", "open"]:
            floor = next(e[1] for e, *_ in last if e[0] == "floor")
            yield _feature("blind_hole", faces | floor, params | {"depth_mm": length}, _evidence(*common, ("one_end_open", True, "convex rim"), ("floor_closes", True, f"{len(floor)} face(s)")))
        else:
            yield _feature("cylindrical_hole_wall", faces, params, _evidence(*common, ("ends_understood", False, ",".join(kinds))))


def _blend(s: Surface, solid: Solid) -> bool:
    return s.kind in ("cylinder", "torus") and 0 < s.span <= 0.6 * math.pi and sum(solid.e[k]["convexity"] == "smooth" for k in s.edges) >= 2


def slots(solid: Solid) -> Iterator[dict]:
    half = [s for s in solid.free("cylinder") if s.concave and abs(s.span - math.pi) <= math.radians(ANGLE_DEG)]
    used: set[int] = set()
    for n, a in enumerate(half):
        for b in half[n + 1 :]:
            walls = {i for i in solid.by(a.i, "smooth") & solid.by(b.i, "smooth") if solid.f[i].kind == "plane" and i not in solid.claimed}
            if {a.i, b.i} & used or abs(a.radius - b.radius) > LENGTH_MM or not along(a.axis, b.axis) or len(walls) != 2:
                continue
            p, q = (solid.f[i] for i in sorted(walls))
            gap = abs(float((p.centroid - q.centroid) @ _unit(p.normal)))
            apart = b.foot() - a.foot()
            floor = {i for i in solid.by(a.i, "concave") & solid.by(b.i, "concave") if solid.f[i].kind == "plane" and i not in solid.claimed}
            used |= {a.i, b.i}
            yield _feature("slot", {a.i, b.i} | walls | floor, {"width_mm": 2 * a.radius, "length_mm": float(np.linalg.norm(apart)) + 2 * a.radius}, _evidence(("half_cylinders_match", True, "radius and axis"), ("two_shared_walls", True, "smooth joints"), ("walls_face", float(_unit(p.normal) @ _unit(q.normal)) <= -_COS, "opposite normals"), ("gap_is_width", abs(gap - 2 * a.radius) <= 1e-2, f"{gap:.4f}")))
    for floor in solid.free("plane"):
        walls: dict[int, int | None] = {}
        for i in solid.by(floor.i, "concave"):
            walls[i] = None
        for i in solid.by(floor.i, "smooth"):
            if _blend(solid.f[i], solid) and solid.f[i].concave:
                walls |= {j: i for j in solid.by(i, "smooth") if j != floor.i}
        walls = {i: b for i, b in walls.items() if solid.f[i].kind == "plane" and i not in solid.claimed and across(solid.f[i].normal, floor.normal)}
        if len(walls) != 2:
            continue
        p, q = (solid.f[i] for i in sorted(walls))
        between = q.centroid - p.centroid
        if float(_unit(p.normal) @ _unit(q.normal)) > -_COS or float(between @ p.normal) <= 0:  # they have to look at each other
            continue
        inner = {p.i, q.i} | {b for b in walls.values() if b is not None}
        rest = [solid.e[k] for k in floor.outer if not set(solid.e[k]["adjacent"]) & inner]
        if not rest or any(e["convexity"] != "convex" for e in rest):
            continue
        width = abs(float(between @ _unit(p.normal)))
        yield _feature("slot", {floor.i} | inner, {"width_mm": width}, _evidence(("two_walls", True, "perpendicular to the floor"), ("walls_face", True, "opposite normals"), ("open_ends", True, f"{len(rest)} convex edge(s)")))


def pockets(solid: Solid) -> Iterator[dict]:
    for floor in solid.free("plane"):
        outer = [solid.e[k] for k in floor.outer]
        if len(outer) < 3 or any(e["convexity"] != "concave" for e in outer):
            continue
        start = {j for e in outer for j in e["adjacent"]} - {floor.i}
        if start & solid.claimed:
            continue
        walls, todo = set(), set(start)
        while todo:
            i = todo.pop()
            walls.add(i)
            todo |= {j for j in solid.by(i, "smooth") if solid.f[j].kind in ("plane", "cylinder") and j not in solid.claimed and j != floor.i} - walls
        upright = lambda s: (s.kind == "plane" and across(s.normal, floor.normal)) or (s.kind == "cylinder" and s.concave and along(s.axis, floor.normal))
        if not all(upright(solid.f[i]) for i in walls):
            continue
        n = np.abs(_unit(floor.normal))
        depth = max(float((solid.f[i].high - solid.f[i].low) @ n) for i in walls)
        rim = any(solid.e[k]["convexity"] == "convex" for i in walls for k in solid.f[i].edges)
        yield _feature("pocket", {floor.i} | walls, {"depth_mm": depth}, _evidence(("closed_floor", True, f"{len(outer)} concave edges"), ("upright_walls", True, f"{len(walls)} wall(s)"), ("convex_rim", rim, "opening")))


def fillets(solid: Solid) -> Iterator[dict]:
    near = 10 * max(LENGTH_MM, 1e-4)
    for s in solid.f.values():
        if s.i in solid.claimed or not _blend(s, solid):
            continue
        if s.kind == "cylinder":  # part of a larger cylinder, cut by others?
            ring = solid.reach({s.i}, lambda i, s=s: (t := solid.f[i]).kind == "cylinder" and t.concave == s.concave and along(t.axis, s.axis) and np.linalg.norm(t.foot() - s.foot()) < near and abs(t.radius - s.radius) < near)
            if sum(solid.f[i].span for i in ring or ()) > 0.6 * math.pi:
                continue
        r = s.radius if s.kind == "cylinder" else s.minor
        yield _feature("fillet", {s.i}, {"radius_mm": r}, _evidence(("short_sweep", True, f"{math.degrees(s.span):.1f} degrees"), ("smooth_sides", True, "two or more"), ("small_radius", r < 0.1 * solid.diagonal, f"{r:.4f}")))


RULES = (holes, slots, pockets, fillets)


def recognize_part(faces: list[dict], edges: list[dict]) -> list[dict]:
    """Features in order, with ids. A rule sees what earlier rules claimed; a feature that touches a claimed face is dropped."""
    solid, out = Solid(faces, edges), []
    for rule in RULES:
        for f in list(rule(solid)):
            if not solid.claimed & set(f["faces"]):
                solid.claimed |= set(f["faces"])
                out.append(f)
    for s in solid.f.values():
        if s.i not in solid.claimed:
            out.append(_feature("planar_face", [s.i], {}, _evidence(("plane", True, "no other feature"))) if s.kind == "plane" else _feature("unknown", [s.i], {}, []))
    order = list(FEATURE_LABELS)
    out.sort(key=lambda f: (order.index(f["type"]), f["faces"]))
    counts: dict[str, int] = {}
    for f in out:
        prefix = FEATURE_PREFIXES[f["type"]]
        counts[prefix] = counts.get(prefix, 0) + 1
        f["id"] = f"{prefix}{counts[prefix]:03d}"
    return out


def recognize(faces: DataFrame, edges: DataFrame) -> DataFrame:
    """Features of all parts; both tables as in ``facetlake.schemas``."""
    plain = lambda v: v.asDict(recursive=True) if hasattr(v, "asDict") else v

    def run(f: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        rows = [{k: plain(v) for k, v in r.items()} for r in f.to_dict("records")]
        found = recognize_part(rows, e.to_dict("records")) if rows else []
        score = lambda ev: round(CAP * sum(x["passed"] for x in ev) / max(len(ev), 1), 4)
        return pd.DataFrame([(rows[0]["sample_id"], x["id"], x["type"], x["faces"], x["params"], score(x["evidence"]), x["evidence"]) for x in found], columns=[c.name for c in FEATURES])

    return faces.groupBy("sample_id").cogroup(edges.groupBy("sample_id")).applyInPandas(run, FEATURES)
