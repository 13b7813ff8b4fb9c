"""Image sizes, frame choices and coordinates as Spark expressions.

Every builder takes columns (or plain numbers) and returns a column, so plans
stay inside generated code. Products of sides are formed in double: two 32-bit
sides overflow. Rounding is half-to-even (``rint``) throughout.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

# Fixed values of the media rules.
MAX_SIDE_RATIO = 200
IMAGE_MIN_TOKENS = 4
IMAGE_MAX_TOKENS = 16384
VIDEO_FRAME_MIN_TOKENS = 128
VIDEO_FRAME_MAX_TOKENS = 768
FRAME_FACTOR = 2
DEFAULT_FPS = 2.0
MIN_FRAMES = 4
MAX_FRAMES = 768
CONTEXT_TOKENS = 128000
CONTEXT_SHARE = 0.9
TRAINING_MIN_PIXELS = 56 * 56
TRAINING_MAX_PIXELS = 14 * 14 * 4 * 1280
PAGE_MAX_SIDE = 1500

Number = Column | int | float


def _c(value: Number | str) -> Column:
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)


def _d(value: Number | str) -> Column:
    return _c(value).cast("double")


def round_to(number: Number, factor: Number) -> Column:
    return F.rint(_d(number) / _d(factor)) * _d(factor)


def ceil_to(number: Number, factor: Number) -> Column:
    return F.ceil(_d(number) / _d(factor)) * _d(factor)


def floor_to(number: Number, factor: Number) -> Column:
    return F.floor(_d(number) / _d(factor)) * _d(factor)


def _side(side: Column, rounded: Column, area: Column, beta_area: Column, factor: Column,
          lo: Column, hi: Column) -> Column:
    """One side after the pixel bounds: shrink, grow or keep the rounded size."""
    shrunk = floor_to(side / F.sqrt(area / hi), factor)
    grown = ceil_to(side * F.sqrt(lo / area), factor)
    fitted = F.when(beta_area > hi, shrunk).when(beta_area < lo, grown).otherwise(rounded)
    return fitted.cast("bigint")


def _plan(h: Column, w: Column, factor: Number, lo: Number, hi: Number, error: Column,
          at_least_factor: bool) -> Column:
    f, lo, hi = _d(factor), _d(lo), _d(hi)
    rh, rw = round_to(h, f), round_to(w, f)
    if at_least_factor:
        rh, rw = F.greatest(f, rh), F.greatest(f, rw)
    area = h * w
    ok = error.isNull()
    return F.struct(
        F.when(ok, _side(h, rh, area, rh * rw, f, lo, hi)).alias("height"),
        F.when(ok, _side(w, rw, area, rh * rw, f, lo, hi)).alias("width"),
        error.alias("error"),
    )


def _ratio_error(h: Column, w: Column) -> Column:
    return F.when(F.greatest(h, w) > F.least(h, w) * MAX_SIDE_RATIO, F.lit("aspect ratio"))


def resize_plan(height: Number, width: Number, factor: Number,
                min_pixels: Number | None = None, max_pixels: Number | None = None) -> Column:
    """Main rule: struct of height, width and error."""
    h, w, f = _d(height), _d(width), _d(factor)
    lo = f * f * IMAGE_MIN_TOKENS if min_pixels is None else _d(min_pixels)
    hi = f * f * IMAGE_MAX_TOKENS if max_pixels is None else _d(max_pixels)
    error = F.coalesce(F.when(hi < lo, F.lit("pixel bounds")), _ratio_error(h, w))
    return _plan(h, w, f, lo, hi, error, at_least_factor=True)


def resize_plan_training(height: Number, width: Number, factor: Number = 28,
                         min_pixels: Number = TRAINING_MIN_PIXELS,
                         max_pixels: Number = TRAINING_MAX_PIXELS) -> Column:
    """Rule of the box converter: a side below the factor is an error."""
    h, w = _d(height), _d(width)
    small = F.when(F.least(h, w) < _d(factor), F.lit("side below factor"))
    error = F.coalesce(small, _ratio_error(h, w))
    return _plan(h, w, factor, min_pixels, max_pixels, error, at_least_factor=False)


def resize_plan_detection(height: Number, width: Number, factor: Number = 28,
                          min_pixels: Number = TRAINING_MIN_PIXELS,
                          max_pixels: Number = TRAINING_MAX_PIXELS,
                          max_long_side: Number = 8192) -> Column:
    """Rule of the detection set: over-long images shrink first, truncating."""
    h, w, limit = _d(height), _d(width), _d(max_long_side)
    error = F.coalesce(F.when(F.least(h, w) < 2, F.lit("side below 2")), _ratio_error(h, w))
    longest = F.greatest(h, w)
    too_long = longest > limit
    short_h = F.when(too_long, F.floor(h / (longest / limit)).cast("double")).otherwise(h)
    short_w = F.when(too_long, F.floor(w / (longest / limit)).cast("double")).otherwise(w)
    return _plan(short_h, short_w, factor, min_pixels, max_pixels, error, at_least_factor=False)


def image_plan(height: Number, width: Number, patch_size: int = 14,
               resized_height: Column | None = None, resized_width: Column | None = None,
               min_pixels: Column | None = None, max_pixels: Column | None = None) -> Column:
    """Requested size (default bounds) when both sides are given, else the real
    size with the item's own bounds."""
    f = patch_size * 2
    lo = F.lit(float(IMAGE_MIN_TOKENS * f * f)) if min_pixels is None else F.coalesce(
        _d(min_pixels), F.lit(float(IMAGE_MIN_TOKENS * f * f)))
    hi = F.lit(float(IMAGE_MAX_TOKENS * f * f)) if max_pixels is None else F.coalesce(
        _d(max_pixels), F.lit(float(IMAGE_MAX_TOKENS * f * f)))
    own = resize_plan(height, width, f, lo, hi)
    if resized_height is None or resized_width is None:
        return own
    asked = resized_height.isNotNull() & resized_width.isNotNull()
    return F.when(asked, resize_plan(resized_height, resized_width, f)).otherwise(own)


def image_tokens(plan: Column, factor: int) -> Column:
    return F.floor(plan["height"] * plan["width"] / F.lit(factor * factor)).cast("bigint")


# --- video -----------------------------------------------------------------

def frame_range(total_frames: Number, video_fps: Number,
                video_start: Column | None = None, video_end: Column | None = None) -> Column:
    """Struct start, end, count, error of a time range in seconds."""
    total, fps = _d(total_frames), _d(video_fps)
    begin = _d(video_start) if video_start is not None else F.lit(None).cast("double")
    finish = _d(video_end) if video_end is not None else F.lit(None).cast("double")
    duration = total / fps
    clamp = lambda t: F.greatest(F.lit(0.0), F.least(t, duration))
    first = F.when(begin.isNull(), F.lit(0.0)).otherwise(F.ceil(clamp(begin) * fps).cast("double"))
    last = F.when(finish.isNull(), total - 1).otherwise(
        F.least(F.floor(clamp(finish) * fps).cast("double"), total - 1))
    whole = begin.isNull() & finish.isNull()
    error = (
        F.when(fps <= 0, F.lit("fps not positive"))
        .when(total <= 0, F.lit("no frames"))
        .when(~whole & (first >= last), F.lit("empty time range"))
    )
    ok = error.isNull()
    start = F.when(whole, F.lit(0.0)).otherwise(first)
    end = F.when(whole, total - 1).otherwise(last)
    return F.struct(
        F.when(ok, start).cast("bigint").alias("start"),
        F.when(ok, end).cast("bigint").alias("end"),
        F.when(ok, end - start + 1).cast("bigint").alias("count"),
        error.alias("error"),
    )


def frame_count(total_frames: Number, video_fps: Number, fps: Column | None = None,
                nframes: Column | None = None, min_frames: Column | None = None,
                max_frames: Column | None = None) -> Column:
    """Struct nframes, error. ``fps`` and ``nframes`` exclude each other."""
    total = _d(total_frames)
    null = F.lit(None).cast("double")
    fps, nframes, min_frames, max_frames = (
        null if c is None else _d(c) for c in (fps, nframes, min_frames, max_frames))
    lowest = ceil_to(F.coalesce(min_frames, F.lit(float(MIN_FRAMES))), FRAME_FACTOR)
    highest = floor_to(
        F.coalesce(max_frames, F.least(F.lit(float(MAX_FRAMES)), total)), FRAME_FACTOR)
    wanted = total / _d(video_fps) * F.coalesce(fps, F.lit(DEFAULT_FPS))
    by_rate = floor_to(F.least(F.greatest(wanted, lowest), highest, total), FRAME_FACTOR)
    chosen = F.when(nframes.isNotNull(), round_to(nframes, FRAME_FACTOR)).otherwise(by_rate)
    error = (
        F.when(total.isNull(), F.lit(None).cast("string"))
        .when(fps.isNotNull() & nframes.isNotNull(), F.lit("fps and nframes"))
        .when((chosen < FRAME_FACTOR) | (chosen > total), F.lit("frame count out of range"))
    )
    return F.struct(
        F.when(error.isNull(), chosen).cast("bigint").alias("nframes"), error.alias("error"))


def _linspace(start: Column, end: Column, n: Column, cut) -> Column:
    """n points from start to end, both included, each passed through ``cut``."""
    step = (end - start) / F.greatest(n - 1, F.lit(1))
    return F.when(n > 0, F.transform(
        F.sequence(F.lit(0), (n - 1).cast("int")),
        lambda i: cut(F.when((i == n - 1) & (n > 1), end).otherwise(i * step + start)).cast("bigint"),
    )).otherwise(F.array().cast("array<bigint>"))


def frame_indices_rounded(start: Number, end: Number, n: Number) -> Column:
    return _linspace(_d(start), _d(end), _d(n), F.rint)


def frame_indices_truncated(start: Number, end: Number, n: Number, unique: bool = False) -> Column:
    indices = _linspace(_d(start), _d(end), _d(n), F.floor)
    return F.array_distinct(indices) if unique else indices


def sample_fps(nframes: Number, total_frames: Number, video_fps: Number) -> Column:
    return _d(nframes) / F.greatest(_d(total_frames), F.lit(1e-6)) * _d(video_fps)


def pad_frame_list(frames: Column) -> Column:
    """Repeats the last frame until the count is even."""
    missing = F.size(frames) % FRAME_FACTOR
    return F.when(missing == 0, frames).otherwise(
        F.concat(frames, F.slice(frames, -1, 1)))


def frame_list_metadata(nframes: Number, sample_rate: Number | None = None,
                        raw_rate: Number | None = None) -> Column:
    """Metadata struct of a padded frame list; the total is a double."""
    rate = F.coalesce(_d(sample_rate), F.lit(2.0)) if sample_rate is not None else F.lit(2.0)
    raw = F.coalesce(_d(raw_rate), rate) if raw_rate is not None else rate
    n = _d(nframes)
    return F.struct(
        raw.alias("fps"),
        F.sequence(F.lit(0).cast("bigint"), n.cast("bigint") - 1).alias("frames_indices"),
        (n / rate * raw).alias("total_num_frames"),
    )


def video_max_pixels(nframes: Number, factor: int, min_pixels: Column | None = None,
                     total_pixels: Column | None = None,
                     max_pixels: Column | None = None) -> Column:
    """Pixel ceiling of one frame under the budget of the whole clip."""
    area = factor * factor
    lo = F.lit(float(VIDEO_FRAME_MIN_TOKENS * area)) if min_pixels is None else F.coalesce(
        _d(min_pixels), F.lit(float(VIDEO_FRAME_MIN_TOKENS * area)))
    budget = CONTEXT_TOKENS * area * CONTEXT_SHARE
    total = F.lit(budget) if total_pixels is None else F.coalesce(_d(total_pixels), F.lit(budget))
    limit = F.greatest(
        F.least(F.lit(float(VIDEO_FRAME_MAX_TOKENS * area)), total / _d(nframes) * FRAME_FACTOR),
        F.floor(lo * 1.05).cast("double"))
    if max_pixels is None:
        return limit
    return F.least(F.coalesce(_d(max_pixels), limit), limit)


def video_frame_plan(height: Number, width: Number, nframes: Number, patch_size: int = 14,
                     min_pixels: Column | None = None, total_pixels: Column | None = None,
                     max_pixels: Column | None = None) -> Column:
    f = patch_size * 2
    lo_default = F.lit(float(VIDEO_FRAME_MIN_TOKENS * f * f))
    lo = lo_default if min_pixels is None else F.coalesce(_d(min_pixels), lo_default)
    return resize_plan(height, width, f, lo,
                       video_max_pixels(nframes, f, min_pixels, total_pixels, max_pixels))


def clip_budget(frames: Number, height: Number, width: Number, shortest_edge: Number,
                longest_edge: Number) -> Column:
    """Struct within, tokens: whole-clip budget and its token count."""
    volume = _d(frames) * _d(height) * _d(width)
    return F.struct(
        volume.between(_d(shortest_edge), _d(longest_edge)).alias("within"),
        F.floor(volume / (2 * 32 * 32)).cast("bigint").alias("tokens"),
    )


def frame_uris(folder: Column, end: Number, rate: Number) -> Column:
    """``<folder>/<i>.000.jpg`` for every int(1/rate)-th second below ``end``."""
    step = F.floor(F.lit(1.0) / _d(rate)).cast("int")
    last = _c(end).cast("int") - 1
    return F.when(last >= 0, F.transform(
        F.sequence(F.lit(0), last, step),
        lambda i: F.concat(folder, F.lit("/"), i.cast("string"), F.lit(".000.jpg")),
    )).otherwise(F.array().cast("array<string>"))


# --- coordinates ------------------------------------------------------------

def to_relative(position: Number, size: Number) -> Column:
    """0..1000 position of a pixel coordinate."""
    scaled = F.rint(_d(position) / _d(size) * 1000)
    return F.greatest(F.lit(0.0), F.least(scaled, F.lit(1000.0))).cast("bigint")


def to_resized(position: Number, size: Number, new_size: Number) -> Column:
    """Pixel coordinate after resizing, kept inside the image."""
    scaled = F.rint(_d(position) * (_d(new_size) / _d(size)))
    return F.greatest(F.lit(0.0), F.least(scaled, _d(new_size) - 1)).cast("bigint")


def from_relative(position: Number, size: Number, truncate: bool = False) -> Column:
    """Pixels of a 0..1000 position; points truncate the position first."""
    p = _d(position)
    if truncate:
        p = F.when(p >= 0, F.floor(p)).otherwise(F.ceil(p)).cast("double")
    return p / 1000 * _d(size)


def click_position(position: Number, size: Number) -> Column:
    return F.rint(_d(position) / 999 * _d(size)).cast("bigint")


def box_to_xywh(box: Column) -> Column:
    """[x1, y1, x2, y2] to [x, y, width, height]."""
    return F.array(box[0], box[1], box[2] - box[0], box[3] - box[1])


def _round2(value: Column) -> Column:
    return F.rint(value * 100) / 100


def pseudo_camera(width: Number, height: Number, fov: Number = 60, fx: Column | None = None,
                  fy: Column | None = None, cx: Column | None = None,
                  cy: Column | None = None) -> Column:
    """Camera struct; given focal lengths or centres count only as pairs."""
    none = F.lit(None).cast("double")
    fx, fy, cx, cy = (none if c is None else _d(c) for c in (fx, fy, cx, cy))
    spread = F.tan(F.radians(_d(fov)) / 2) * 2
    focal = fx.isNotNull() & fy.isNotNull()
    centre = cx.isNotNull() & cy.isNotNull()
    return F.struct(
        F.when(focal, fx).otherwise(_round2(_d(width) / spread)).alias("fx"),
        F.when(focal, fy).otherwise(_round2(_d(height) / spread)).alias("fy"),
        F.when(centre, cx).otherwise(_d(width) / 2).alias("cx"),
        F.when(centre, cy).otherwise(_d(height) / 2).alias("cy"),
    )


def project_box3d(box: Column, camera: Column, angle_scale: float = 1.0) -> Column:
    """Image corners of [x, y, z, sx, sy, sz, pitch, yaw, roll], angles in degrees.

    The eight corners run over the signs of the half sizes, z fastest; corners
    behind the camera are left out, so only eight-corner results are drawable.
    """
    angles = [F.radians(box[i] * angle_scale) for i in range(6, 9)]
    known = F.struct(
        *[(box[i] / 2).alias(n) for i, n in zip(range(3, 6), ("hx", "hy", "hz"))],
        *[f(a).alias(n + m) for a, n in zip(angles, ("pitch_", "yaw_", "roll_")) for f, m in ((F.cos, "c"), (F.sin, "s"))])
    signs = F.array(*[F.struct(F.lit(sx).alias("x"), F.lit(sy).alias("y"), F.lit(sz).alias("z"))
                      for sx in (1.0, -1.0) for sy in (1.0, -1.0) for sz in (1.0, -1.0)])
    point = lambda x, y, z: F.struct(x.alias("x"), y.alias("y"), z.alias("z"))

    def corners(k: Column) -> Column:
        sized = F.transform(signs, lambda p: point(k["hx"] * p["x"], k["hy"] * p["y"], k["hz"] * p["z"]))
        pitched = F.transform(sized, lambda p: point(
            p["x"], p["y"] * k["pitch_c"] - p["z"] * k["pitch_s"], p["y"] * k["pitch_s"] + p["z"] * k["pitch_c"]))
        yawed = F.transform(pitched, lambda p: point(
            p["x"] * k["yaw_c"] + p["z"] * k["yaw_s"], p["y"], p["z"] * k["yaw_c"] - p["x"] * k["yaw_s"]))
        return F.transform(yawed, lambda p: point(
            p["x"] * k["roll_c"] - p["y"] * k["roll_s"] + box[0], p["x"] * k["roll_s"] + p["y"] * k["roll_c"] + box[1], p["z"] + box[2]))

    visible = F.filter(let(known, corners), lambda p: p["z"] > 0)
    return F.transform(visible, lambda p: F.array(
        camera["fx"] * (p["x"] / p["z"]) + camera["cx"],
        camera["fy"] * (p["y"] / p["z"]) + camera["cy"]))


# --- pages, sheets, thumbnails -----------------------------------------------

def page_plan(width: Number, height: Number, max_side: int = PAGE_MAX_SIDE) -> Column:
    w, h = _c(width).cast("bigint"), _c(height).cast("bigint")
    longest = F.greatest(w, h)
    shrink = lambda side: F.when(
        longest > max_side, F.floor(side * max_side / longest)).otherwise(side).cast("bigint")
    return F.struct(shrink(w).alias("width"), shrink(h).alias("height"))


def sheet_cell(index: Number, columns: int, width: Number, height: Number) -> Column:
    """Place of the index-th picture (from 0) on a sheet with ``columns`` columns."""
    i = _c(index).cast("bigint")
    row, col = F.floor(i / columns).cast("bigint"), i % columns
    return F.struct(row.alias("row"), col.alias("col"), (col * _c(width)).alias("x"),
                    (row * _c(height)).alias("y"))


def sheet_size(pictures: Number, columns: int, width: Number, height: Number) -> Column:
    rows = F.ceil(_d(pictures) / columns).cast("bigint")
    return F.struct((_c(width) * columns).cast("bigint").alias("width"),
                    (rows * _c(height)).cast("bigint").alias("height"))


def thumbnail_plan(width: Number, height: Number, target: int) -> Column:
    """Longest side becomes ``target``, the other follows, truncated."""
    w, h = _d(width), _d(height)
    return F.struct(
        F.when(w > h, F.lit(target)).otherwise(F.floor(w * target / h)).cast("bigint").alias("width"),
        F.when(w > h, F.floor(h * target / w)).otherwise(F.lit(target)).cast("bigint").alias("height"),
    )
