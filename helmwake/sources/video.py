"""Video access, through a codec library where one is installed."""

from __future__ import annotations

from helmwake.sources.images import CodecUnavailable

try:
    import av
except ImportError:  # not part of the base installation
    av = None


def _need() -> None:
    if av is None:
        raise CodecUnavailable("reading and writing video needs the package 'av'")


def video_info(path: str) -> dict:
    """Height, width, codec, pixel format and frame rate of the first video stream."""
    _need()
    with av.open(path) as c:
        s = c.streams.video[0]
        return {"height": s.height, "width": s.width, "codec": s.codec_context.name, "pix_fmt": s.codec_context.pix_fmt, "fps": float(s.average_rate)}


def frames_at(path: str, timestamps: list[float], tolerance: float) -> list:
    """The decoded frames nearest to the timestamps; one farther than the tolerance is an error."""
    _need()
    with av.open(path) as c:
        decoded = [(float(f.time), f.to_ndarray(format="rgb24")) for f in c.decode(video=0)]
    out = []
    for t in timestamps:
        at, px = min(decoded, key=lambda d: abs(d[0] - t))
        if abs(at - t) >= tolerance:
            raise ValueError(f"no frame within {tolerance} s of {t}")
        out.append(px)
    return out


def encode(images: list, path: str, fps: int, codec: str = "h264", pix_fmt: str = "yuv420p", g: int = 2, crf: int = 30) -> None:
    """Writes RGB arrays as a video."""
    _need()
    with av.open(path, "w") as c:
        s = c.add_stream(codec, rate=fps, options={"g": str(g), "crf": str(crf)})
        s.height, s.width, s.pix_fmt = images[0].shape[0], images[0].shape[1], pix_fmt
        for x in images:
            for packet in s.encode(av.VideoFrame.from_ndarray(x, format="rgb24")):
                c.mux(packet)
        for packet in s.encode():
            c.mux(packet)
