"""Views of a mesh: cameras, a z-buffer of face ids, and the checks of the buffers."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetlake.functions.storage import spread

N_VIEWS, RESOLUTION, FOV, ELEVATION = 6, 256, 35.0, 30.0


def camera(view: int, centre: np.ndarray, radius: float, fov: float = FOV) -> dict[str, np.ndarray]:
    """Eye and frame of one view: azimuths 60 degrees apart from 45 on, elevations alternating in sign, far enough for the whole ball."""
    azimuth, elevation = math.radians(45 + 60 * view), math.radians(ELEVATION if view % 2 == 0 else -ELEVATION)
    back = np.array([math.cos(elevation) * math.cos(azimuth), math.cos(elevation) * math.sin(azimuth), math.sin(elevation)])
    eye = centre + back * 1.05 * radius / math.sin(math.radians(fov) / 2)
    right = np.cross(-back, [0.0, 0.0, 1.0])
    right /= np.linalg.norm(right)
    return {"eye": eye, "forward": -back, "right": right, "up": np.cross(right, -back)}


def rasterize(corners: np.ndarray, cam: dict[str, np.ndarray], resolution: int, fov: float = FOV, most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """(triangle, depth) per pixel, -1 and infinity where there is none; corners are [triangle, 3, xyz].

    Depth runs along the view and is linear in one over itself across the image. Triangles seen from behind are drawn too; nearest wins, and of equals the first.
    """
    frame = np.stack([cam["right"], cam["up"], cam["forward"]])
    local = (corners - cam["eye"]) @ frame.T
    z = local[..., 2]
    focal = 1 / math.tan(math.radians(fov) / 2)
    px = (local[..., 0] / z * focal + 1) * resolution / 2 - 0.5
    py = (1 - local[..., 1] / z * focal) * resolution / 2 - 0.5
    owner, depth = np.full(resolution * resolution, -1), np.full(resolution * resolution, np.inf)
    area = (px[:, 1] - px[:, 0]) * (py[:, 2] - py[:, 0]) - (px[:, 2] - px[:, 0]) * (py[:, 1] - py[:, 0])
    ahead = np.flatnonzero((z > 1e-9).all(1) & (np.abs(area) > 1e-12))
    px, py, z, area = px[ahead], py[ahead], z[ahead], area[ahead]
    box = lambda p: (np.clip(np.ceil(p.min(1)), 0, resolution).astype(int), np.clip(np.floor(p.max(1)), -1, resolution - 1).astype(int))
    (c0, c1), (r0, r1) = box(px), box(py)
    width = np.maximum(c1 - c0 + 1, 0)
    size = width * np.maximum(r1 - r0 + 1, 0)  # pixels of each triangle's box; they are looked at together, so many triangles at a time that memory stays bounded
    blocks = np.split(np.arange(len(ahead)), np.flatnonzero(np.diff((np.cumsum(size) - 1) // most)) + 1)
    for block in blocks:
        n = size[block]
        t, k = np.repeat(block, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        gx, gy = c0[t] + k % np.maximum(width[t], 1), r0[t] + k // np.maximum(width[t], 1)
        x, y = px[t], py[t]
        w1 = ((gx - x[:, 0]) * (y[:, 2] - y[:, 0]) - (x[:, 2] - x[:, 0]) * (gy - y[:, 0])) / area[t]
        w2 = ((x[:, 1] - x[:, 0]) * (gy - y[:, 0]) - (gx - x[:, 0]) * (y[:, 1] - y[:, 0])) / area[t]
        w0 = 1 - w1 - w2
        inside = np.flatnonzero((w0 >= -1e-9) & (w1 >= -1e-9) & (w2 >= -1e-9))
        t, place = t[inside], (gy * resolution + gx)[inside]
        d = 1 / (w0[inside] / z[t, 0] + w1[inside] / z[t, 1] + w2[inside] / z[t, 2])
        order = np.lexsort((d, place))  # stable: of equals the first triangle
        best = order[np.flatnonzero(np.diff(place[order], prepend=-1))]
        best = best[d[best] < depth[place[best]]]
        depth[place[best]], owner[place[best]] = d[best], ahead[t[best]]
    return owner.reshape(resolution, resolution), depth.reshape(resolution, resolution)


def view_pixels(triangles: DataFrame, n_views: int = N_VIEWS, resolution: int = RESOLUTION) -> DataFrame:
    """(sample_id, view, row, col, depth, face_idx, nx, ny, nz) of covered pixels; ``triangles`` has (sample_id, face_idx, tri_idx, a, b, c). A part's mesh is one task's work."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("tri_idx", kind="stable")
        corners = np.array([[[p[k] for k in "xyz"] for p in (r.a, r.b, r.c)] for r in pdf.itertuples()])
        faces = pdf["face_idx"].to_numpy()
        normals = np.cross(corners[:, 1] - corners[:, 0], corners[:, 2] - corners[:, 0])
        normals /= np.maximum(np.linalg.norm(normals, axis=1, keepdims=True), 1e-30)
        low, high = corners.min((0, 1)), corners.max((0, 1))
        out = []
        for view in range(n_views):
            owner, depth = rasterize(corners, camera(view, (low + high) / 2, float(np.linalg.norm(high - low)) / 2 or 1.0), resolution)
            r, c = np.nonzero(owner >= 0)
            t = owner[r, c]
            out.append((np.full(len(t), view), r, c, depth[r, c], faces[t], normals[t, 0], normals[t, 1], normals[t, 2]))
        columns = dict(zip(("view", "row", "col", "depth", "face_idx", "nx", "ny", "nz"), map(np.concatenate, zip(*out, strict=True)), strict=True))
        return pd.DataFrame({"sample_id": pdf["sample_id"].iloc[0]} | columns, index=np.arange(len(columns["view"])))

    # Dealt by number: by their few bytes AQE would put all parts, which are long work, into one task.
    return spread(triangles, 0, "sample_id").groupBy("sample_id").applyInPandas(run, "sample_id string, view int, row int, col int, depth double, face_idx int, nx double, ny double, nz double")


def pixel_counts(pixels: DataFrame) -> DataFrame:
    return pixels.groupBy("sample_id", "view", "face_idx").agg(F.count(F.lit(1)).alias("pixels"))


def pick(pixels: DataFrame, sample: str, view: int, row: int, col: int) -> DataFrame:
    """The face at a pixel; no row for background."""
    return pixels.where((F.col("sample_id") == sample) & (F.col("view") == view) & (F.col("row") == row) & (F.col("col") == col)).select("face_idx")
