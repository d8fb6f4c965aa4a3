"""Waveform measures that need numpy only, header checks, and interfaces for outside codecs.

Decoding, cutting and the large feature sets belong to outside programs; ``Decoder``, ``Cutter``, ``Tester`` and ``FeatureSet`` are where they
plug in. WAV files are decoded here with the standard library, and FLAC headers are read.
"""

from __future__ import annotations

import io
import subprocess
import wave
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPS, FRAME, HOP = 1e-10, 1024, 256
F0_MIN, F0_MAX, VOICED, STRONG = 65.0, 500.0, 0.3, 0.85
# The features' names.
FEATURES = (
    "duration_s", "rms_mean", "rms_std", "rms_max", "loudness_dbfs", "peak_dbfs", "crest_db", "dyn_range_db", "clipping_ratio",
    "silence_ratio", "lead_silence_s", "trail_silence_s", "n_pauses", "edge_start_ratio", "edge_end_ratio",
    "f0_mean_hz", "f0_median_hz", "voiced_ratio", "f0_std_semitones", "f0_range_semitones",
    "spec_centroid_mean", "spec_centroid_std", "spec_bandwidth_mean", "spec_rolloff_mean", "spec_flatness_mean", "zcr_mean", "hf_energy_ratio",
    "harmonic_ratio", "onset_rate",
)
#: Frames of the separation and the onsets, bands of the onsets, and the length of the medians.
WIDE, WIDE_HOP, BANDS, MEDIAN = 2048, 512, 128, 31
HEADER_BYTES = 65_536


class Decoder(Protocol):
    def __call__(self, content: bytes) -> tuple[np.ndarray, int]: ...


class Cutter(Protocol):
    """Cuts [start, start + duration) out of a file; returns the new file's bytes."""

    def __call__(self, content: bytes, start: float, duration: float, rate: int) -> bytes: ...


class Tester(Protocol):
    """What is wrong with an encoded file after a whole decode; None if nothing."""

    def __call__(self, content: bytes) -> str | None: ...


class FeatureSet(Protocol):
    """A large feature set of an outside program: its names, and one value a name for a waveform."""

    names: list[str]

    def __call__(self, y: np.ndarray, sr: int) -> list[float]: ...


def decode_wav(content: bytes) -> tuple[np.ndarray, int]:
    """16-bit WAV as mono floats; stereo is averaged."""
    with wave.open(io.BytesIO(content)) as w:
        y = np.frombuffer(w.readframes(w.getnframes()), "<i2").astype(np.float64) / 32768
        return y.reshape(-1, w.getnchannels()).mean(axis=1), w.getframerate()


def cut_wav(content: bytes, start: float, duration: float, rate: int = 24000) -> bytes:
    """A mono WAV fragment at ``rate``, resampled by linear interpolation."""
    y, sr = decode_wav(content)
    part = y[int(round(start * sr)) : int(round((start + duration) * sr))]
    n = int(round(len(part) * rate / sr))
    part = np.interp(np.arange(n) * sr / rate, np.arange(len(part)), part) if len(part) else part
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(part, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def pitch(y: np.ndarray, sr: int, frame_s: float = 0.04, hop_s: float = 0.01, quiet: float = 1e-4) -> tuple[np.ndarray, float]:
    """Fundamental of each voiced frame and the share of voiced frames, by autocorrelation.

    All frames go through one FFT. Among lags whose peak is near the best, the longest is the fundamental.
    """
    size, hop = int(frame_s * sr), int(hop_s * sr)
    if len(y) < size:
        return np.empty(0), 0.0
    frames = np.lib.stride_tricks.sliding_window_view(y, size)[::hop] * np.hanning(size)
    spectrum = np.fft.rfft(frames, 2 * size, axis=1)
    auto = np.fft.irfft(np.abs(spectrum) ** 2, axis=1)[:, :size]
    low, high = int(sr / F0_MAX), int(sr / F0_MIN)
    seg = auto[:, low : high + 1]
    if not seg.shape[1]:
        return np.empty(0), 0.0
    best = seg.max(axis=1)
    loud = np.sqrt((frames**2).mean(axis=1)) >= quiet
    ok = loud & (auto[:, 0] > 0) & (best >= VOICED * auto[:, 0])
    near = seg >= STRONG * best[:, None]
    last = seg.shape[1] - 1 - near[:, ::-1].argmax(axis=1)
    return sr / (low + last[ok]), float(ok.mean())


def _magnitudes(y: np.ndarray, size: int, hop: int) -> np.ndarray:
    """Complex spectra of centred frames under a periodic Hann window, a row a frame."""
    frames = np.lib.stride_tricks.sliding_window_view(np.pad(y, size // 2), size)[::hop]
    return np.fft.rfft(frames * np.hanning(size + 1)[:-1], axis=1)


def _back(spectra: np.ndarray, size: int, hop: int, n: int) -> np.ndarray:
    """The waveform of centred spectra: overlapping frames, divided by the sum of squared windows."""
    window = np.hanning(size + 1)[:-1]
    out = np.zeros(size + hop * (len(spectra) - 1))
    norm = np.zeros_like(out)
    for k, frame in enumerate(np.fft.irfft(spectra, size, axis=1) * window):
        out[k * hop : k * hop + size] += frame
        norm[k * hop : k * hop + size] += window**2
    out = np.where(norm > 1e-12, out / np.where(norm > 1e-12, norm, 1.0), out)
    return out[size // 2 : size // 2 + n]


def _running_median(x: np.ndarray, axis: int) -> np.ndarray:
    """Medians of ``MEDIAN`` neighbours along an axis, mirrored at the ends; some rows at a time, so memory stays bounded."""
    x = np.moveaxis(x, axis, 1)
    padded = np.pad(x, ((0, 0), (MEDIAN // 2, MEDIAN // 2)), mode="symmetric")
    parts = [np.median(np.lib.stride_tricks.sliding_window_view(padded[i : i + 64], MEDIAN, axis=1), axis=2) for i in range(0, len(x), 64)]
    return np.moveaxis(np.concatenate(parts), 1, axis)


def harmonic_share(y: np.ndarray) -> float:
    """Energy of the harmonic part over both parts, separated by medians along time and along frequency (Fitzgerald 2010)."""
    spectra = _magnitudes(y, WIDE, WIDE_HOP)
    size = np.abs(spectra)
    steady, struck = _running_median(size, 0) ** 2, _running_median(size, 1) ** 2
    both = steady + struck
    mask = np.where(both > 0, steady / np.where(both > 0, both, 1.0), 0.5)
    one, two = ((_back(spectra * m, WIDE, WIDE_HOP, len(y)) ** 2).sum() for m in (mask, 1 - mask))
    return one / (one + two + EPS)


def mel_bands(sr: int, size: int, bands: int) -> np.ndarray:
    """Triangular bands of equal area on the mel scale that is linear below 1 kHz and logarithmic above."""
    step = np.log(6.4) / 27
    to_mel = lambda f: f * 3 / 200 if f < 1000 else 15 + np.log(f / 1000) / step
    mel = np.linspace(0, to_mel(sr / 2), bands + 2)
    edges = np.where(mel < 15, mel * 200 / 3, 1000 * np.exp(step * (mel - 15)))
    freqs = np.fft.rfftfreq(size, 1 / sr)
    rise = (freqs - edges[:-2, None]) / np.diff(edges)[:-1, None]
    fall = (edges[2:, None] - freqs) / np.diff(edges)[1:, None]
    return np.maximum(0, np.minimum(rise, fall)) * (2 / (edges[2:] - edges[:-2]))[:, None]


def onsets(y: np.ndarray, sr: int) -> np.ndarray:
    """Frames (``HOP`` samples each) where the mean rise of the mel bands in dB peaks above its surroundings."""
    power = np.abs(_magnitudes(y, WIDE, HOP)) ** 2 @ mel_bands(sr, WIDE, BANDS).T
    db = 10 * np.log10(np.maximum(power, EPS))
    db = np.maximum(db, db.max() - 80)
    rise = np.maximum(np.diff(db, axis=0), 0).mean(axis=1)
    x = np.pad(rise, (1 + WIDE // (2 * HOP), 0))[: len(db)]
    x = x - x.min()
    if not x.any():
        return np.empty(0, int)
    x = x / x.max()
    near, around, found = int(0.03 * sr // HOP), int(0.1 * sr // HOP), []
    for k in range(len(x)):
        peak = x[k] == x[max(0, k - near) : k + 1].max() and x[k] >= x[max(0, k - around) : k + around + 1].mean() + 0.07
        if peak and (not found or k - found[-1] > near):
            found.append(k)
    return np.array(found, int)


def spectral(y: np.ndarray, sr: int) -> dict[str, float]:
    """Centroid, bandwidth, roll-off at 85 % and flatness of the frames, and the share of energy above 4 kHz."""
    s = np.abs(_magnitudes(y, FRAME, HOP))
    freqs = np.fft.rfftfreq(FRAME, 1 / sr)
    total = s.sum(axis=1, keepdims=True)
    share = s / np.where(total > 0, total, 1.0)
    centre = share @ freqs
    spread = np.sqrt((share * (freqs - centre[:, None]) ** 2).sum(axis=1))
    summed = s.cumsum(axis=1)
    roll = freqs[(summed >= 0.85 * summed[:, -1:]).argmax(axis=1)]
    power = s**2
    floor = np.maximum(power, EPS)
    flat = np.exp(np.log(floor).mean(axis=1)) / floor.mean(axis=1)
    return {
        "spec_centroid_mean": centre.mean(), "spec_centroid_std": centre.std(), "spec_bandwidth_mean": spread.mean(), "spec_rolloff_mean": roll.mean(),
        "spec_flatness_mean": flat.mean(), "hf_energy_ratio": power[:, freqs >= 4000].sum() / (power.sum() + EPS),
    }


def measure(y: np.ndarray, sr: int) -> dict[str, float | None]:
    """The features of one waveform; all but the duration are null when it is empty."""
    out: dict[str, float | None] = dict.fromkeys(FEATURES)
    out["duration_s"] = len(y) / sr
    if not len(y):
        return out
    padded = np.pad(y, FRAME // 2)
    frames = np.lib.stride_tricks.sliding_window_view(padded, FRAME)[::HOP]
    rms = np.sqrt((frames**2).mean(axis=1))
    db = 20 * np.log10(rms + EPS)
    peak, loud = 20 * np.log10(np.abs(y).max() + EPS), 20 * np.log10(rms.mean() + EPS)
    p5, p95 = np.percentile(rms, [5, 95])
    quiet = db < db.max() - 35
    sounding = np.nonzero(~quiet)[0]
    first, last = (sounding[0], sounding[-1]) if len(sounding) else (0, -1)
    inner = quiet[first : last + 1]
    edge = max(1, int(0.1 * sr))
    f0, voiced = pitch(y, sr)
    held = np.lib.stride_tricks.sliding_window_view(np.pad(np.where(np.abs(y) <= EPS, 0.0, y), FRAME // 2, mode="edge"), FRAME)[::HOP]
    out |= {
        "rms_mean": rms.mean(), "rms_std": rms.std(), "rms_max": rms.max(), "loudness_dbfs": loud, "peak_dbfs": peak, "crest_db": peak - loud,
        "dyn_range_db": 20 * np.log10((p95 + EPS) / (p5 + EPS)), "clipping_ratio": (np.abs(y) >= 0.999).mean(), "silence_ratio": quiet.mean(),
        "lead_silence_s": first * HOP / sr if len(sounding) else out["duration_s"],
        "trail_silence_s": (len(rms) - 1 - last) * HOP / sr if len(sounding) else out["duration_s"],
        "n_pauses": float(np.count_nonzero(inner[1:] & ~inner[:-1])),
        "edge_start_ratio": np.sqrt((y[:edge] ** 2).mean()) / (rms.mean() + EPS), "edge_end_ratio": np.sqrt((y[-edge:] ** 2).mean()) / (rms.mean() + EPS),
        "voiced_ratio": voiced, "zcr_mean": (np.diff(np.signbit(held), axis=1) != 0).sum(axis=1).mean() / FRAME,
        "harmonic_ratio": harmonic_share(y), "onset_rate": len(onsets(y, sr)) / out["duration_s"],
    } | spectral(y, sr)
    if len(f0):
        st = 12 * np.log2(f0)
        a, b = np.percentile(st, [5, 95])
        out |= {"f0_mean_hz": f0.mean(), "f0_median_hz": np.median(f0), "f0_std_semitones": st.std(), "f0_range_semitones": b - a}
    return {k: None if v is None else float(v) for k, v in out.items()}


def features(files: DataFrame, key: str, content: str = "content", decoder: Decoder = decode_wav, more: FeatureSet | None = None) -> DataFrame:
    """(key, features, feat_status) for each file; a failing file is a status, not a failed job. Names of ``more`` get the prefix egm_."""
    extra = [f"egm_{n}" for n in more.names] if more else []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, c in zip(pdf[key], pdf[content], strict=True):
                try:
                    y, sr = decoder(bytes(c))
                    rows.append({key: k, "feat_status": "ok"} | measure(y, sr) | (dict(zip(extra, more(y, sr), strict=True)) if more else {}))
                except Exception as e:  # noqa: BLE001
                    rows.append({key: k, "feat_status": f"error:{type(e).__name__}"})
            yield pd.DataFrame(rows, columns=[key, *FEATURES, *extra, "feat_status"])

    kind = dict(files.dtypes)[key]
    return files.select(key, content).mapInPandas(run, f"`{key}` {kind}, " + ", ".join(f"`{f}` double" for f in (*FEATURES, *extra)) + ", feat_status string")


def cut(fragments: DataFrame, content: str, start: str, duration: str, rate: int = 24000, cutter: Cutter = cut_wav) -> DataFrame:
    """Add ``audio`` and ``cut_status`` (ok, bad_duration or error:<type>)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            audio, states = [], []
            for c, s, d in zip(pdf[content], pdf[start], pdf[duration], strict=True):
                try:
                    good = d is not None and d > 0
                    audio.append(cutter(bytes(c), s, d, rate) if good else None)
                    states.append("ok" if good else "bad_duration")
                except Exception as e:  # noqa: BLE001
                    audio.append(None)
                    states.append(f"error:{type(e).__name__}")
            yield pdf.drop(columns=[content]).assign(audio=audio, cut_status=states)

    rest = [c for c in fragments.columns if c != content]
    schema = ", ".join(f"{c} {t}" for c, t in fragments.select(*rest).dtypes) + ", audio binary, cut_status string"
    return fragments.mapInPandas(run, schema)


def read_header(content: bytes) -> tuple[int, int]:
    """(frames, rate) from the start of a FLAC or WAV file."""
    if content[:4] == b"fLaC":
        # the first block is STREAMINFO: 20 bits of rate, 3 of channels, 5 of sample size, 36 of frames, from its byte 10 on
        if content[4] & 127 or len(content) < 26:
            raise ValueError("no STREAMINFO")
        packed = int.from_bytes(content[18:26], "big")
        return packed & ((1 << 36) - 1), packed >> 44
    with wave.open(io.BytesIO(content)) as w:
        return w.getnframes(), w.getframerate()


def headers(files: DataFrame, key: str, content: str = "content") -> DataFrame:
    """(key, size, frames, rate, header_error) of each file; only the first bytes of each leave the JVM."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for c in pdf["head"]:
                try:
                    rows.append((*read_header(bytes(c)), None))
                except Exception as e:  # noqa: BLE001
                    rows.append((None, None, type(e).__name__))
            found = pd.DataFrame(rows, columns=["frames", "rate", "header_error"], index=pdf.index).astype({"frames": "Int64", "rate": "Int64"})
            yield pd.concat([pdf.drop(columns="head"), found], axis=1)

    slim = files.select(key, F.length(content).cast("long").alias("size"), F.coalesce(F.substring(content, 1, HEADER_BYTES), F.lit(b"")).alias("head"))
    return slim.mapInPandas(run, f"`{key}` {dict(files.dtypes)[key]}, size bigint, frames bigint, rate bigint, header_error string")


def header_status(size: Column, frames: Column, rate: Column, expected: Column, tolerance: float = 0.15, error: Column | None = None) -> Column:
    """ok, missing, empty, header_unreadable (and why), zero_frames or dur_mismatch(got=...,exp=...), from what a header says."""
    got = frames / F.when(rate != 0, rate)
    unread = F.lit("header_unreadable") if error is None else F.concat_ws(":", F.lit("header_unreadable"), error)
    return (
        F.when(size.isNull(), "missing")
        .when(size == 0, "empty")
        .when(frames.isNull() | rate.isNull(), unread)
        .when(frames == 0, "zero_frames")
        .when(F.abs(got - expected) > tolerance, F.format_string("dur_mismatch(got=%.2f,exp=%.2f)", got, expected.cast("double")))
        .otherwise("ok")
    )


def verify(fragments: DataFrame, files: DataFrame, key: str, expected: str, content: str = "content", tolerance: float = 0.15) -> DataFrame:
    """``fragments`` with ``verify_status`` of each one's file by its header; fragments without a file are missing."""
    seen = headers(files, key, content).withColumnsRenamed({c: f"_{c}" for c in ("size", "frames", "rate", "header_error")})
    status = header_status(F.col("_size"), F.col("_frames"), F.col("_rate"), F.col(expected), tolerance, F.col("_header_error"))
    return fragments.join(seen, key, "left").select(*fragments.columns, status.alias("verify_status"))


def flac_test(content: bytes, seconds: int = 120) -> str | None:
    """The outcome of the outside program ``flac -t``, which decodes a whole file and compares its checksum."""
    try:
        done = subprocess.run(["flac", "-t", "--silent", "-"], input=content, capture_output=True, timeout=seconds)
    except subprocess.TimeoutExpired:
        return "flac_test_timeout"
    return f"flac_test_fail:{done.stderr.decode(errors='replace').strip()[:120]}" if done.returncode else None


def deep_check(files: DataFrame, key: str, content: str = "content", tester: Tester = flac_test) -> DataFrame:
    """(key, verify_status) after a whole decode of each file: ok, missing or what the tester says. A missing program fails the job."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            said = ["missing" if c is None else tester(bytes(c)) or "ok" for c in pdf[content]]
            yield pd.DataFrame({key: pdf[key], "verify_status": said})

    return files.select(key, content).mapInPandas(run, f"`{key}` {dict(files.dtypes)[key]}, verify_status string")


def narration_baseline(
    segments: DataFrame, keys: list[str], features_: list[str], row: str, n: int = 200, least_s: float = 1.0, seed: int = 0, books: DataFrame | None = None, present: str = "present"
) -> DataFrame:
    """Median and scaled MAD over a seeded sample of long enough segments with words, and ``base_status`` (``n_segments`` 0 unless ok).

    With ``books`` (keys and ``present``: both files are there) every book has a row: missing_json_or_mp3, no_segments, no_features, error:<type>
    or ok. Segments without a feature are left out; one whose ``feat_status`` is an error fails its book.
    """
    from quillcast.operators.sampling import sample_per_group
    from quillcast.operators.scores import median_mad

    usable = segments.filter((F.col("end") - F.col("start") >= least_s) & (F.col("n_words") > 0))
    some = sample_per_group(usable, keys, row, n, seed)
    measured = F.coalesce(*[F.col(f) for f in features_]).isNotNull()
    failed = F.min(F.when(F.col("feat_status").startswith("error:"), F.col("feat_status"))) if "feat_status" in some.columns else F.lit(None).cast("string")
    counts = some.groupBy(*keys).agg(F.count_if(measured).alias("_n"), failed.alias("_failed"))
    base = median_mad(some.filter(measured), keys, features_)
    if books is None:
        whole, status = counts, F.lit("no_features")
    else:
        whole = books.select(*keys, F.col(present).alias("_present")).join(counts, keys, "left")
        status = F.when(~F.coalesce(F.col("_present"), F.lit(False)), "missing_json_or_mp3").when(F.col("_n").isNull(), "no_segments").when(F.col("_n") == 0, "no_features")
    good = F.col("_failed").isNull() & (F.coalesce("_n", F.lit(0)) > 0)
    good = good if books is None else good & F.coalesce(F.col("_present"), F.lit(False))
    out = whole.join(base, keys, "left").withColumn("base_status", F.when(good, "ok").when(F.col("_failed").isNotNull(), F.col("_failed")).otherwise(status))
    values = [c for c in base.columns if c not in keys]
    ok = F.col("base_status") == "ok"
    return out.select(*keys, *[F.when(ok, F.col(c)).alias(c) for c in values], F.when(ok, F.col("_n")).otherwise(0).alias("n_segments"), "base_status")
