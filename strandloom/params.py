"""Settings of a run: what a configuration may say, with defaults filled in for all it leaves out."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, is_dataclass, replace


@dataclass
class Detection:
    """Floors for elements in variants."""

    least_pident: float = 80.0
    least_size_percent: float = 80.0
    least_read_support: int = 1
    types: str = "INS|DEL"
    fold: bool = True


@dataclass
class Clusters:
    """Distances in bases."""

    reads: int = 50
    calls: int = 100
    window: int = 100
    generations: int = 200


@dataclass
class Sites:
    """Evidence at sites."""

    window: int = 50
    least_mapq: int = 10
    least_clip: int = 200
    flank: int = 30

    def least_percent(self, detection: Detection) -> int:
        """The part of an element that an insertion must reach: ten points under the detection floor, 5 at least."""
        return max(5, int(detection.least_size_percent) - 10)


@dataclass
class Params:
    chrom_keep: str = "."
    detection: Detection = field(default_factory=Detection)
    clusters: Clusters = field(default_factory=Clusters)
    sites: Sites = field(default_factory=Sites)


def merged(given: dict, defaults: dict, keep: tuple[str, ...] = ("DATA",)) -> dict:
    """The given settings with missing keys filled in at every depth, except below the keys in ``keep``."""
    out = dict(given)
    for k, v in defaults.items():
        if k in keep:
            continue
        if k not in out or out[k] is None:
            out[k] = v
        elif isinstance(v, dict) and isinstance(out[k], dict):
            out[k] = merged(out[k], v, keep)
    return out


def params(given: dict) -> Params:
    """Settings from nested dicts; unknown names raise."""

    def build(kind, values):
        known = {f.name: f for f in fields(kind)}
        if unknown := set(values) - set(known):
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        base = kind()
        return kind(**{n: build(type(getattr(base, n)), values[n]) if is_dataclass(getattr(base, n)) else values[n] for n in values})

    return build(Params, given)


def option_string(text: str) -> dict[str, str]:
    """Typed options from a pass-through string such as ``--min-size 80 -k``; flags have the value ''."""
    words, out = text.split(), {}
    for i, w in enumerate(words):
        if w.startswith("-") and not w.lstrip("-").replace(".", "", 1).isdigit():
            follows = words[i + 1] if i + 1 < len(words) else "-"
            out[w.lstrip("-")] = "" if follows.startswith("-") and not follows.lstrip("-").replace(".", "", 1).isdigit() else follows
    return out


# What a pass-through option is called and which setting it is.
OPTIONS = {"p": "least_pident", "min-pident": "least_pident", "s": "least_size_percent", "min-size-percent": "least_size_percent", "r": "least_read_support", "min-read-support": "least_read_support", "k": "types", "type-sv-keep": "types", "c": "fold", "combine": "fold"}


def with_options(given: Params, text: str) -> Params:
    """The settings with those of a pass-through string, such as ``--min-size-percent 80 -k 'INS|DEL'``; unknown options raise."""
    options = option_string(text.replace("'", "").replace('"', ""))
    if unknown := set(options) - set(OPTIONS):
        raise ValueError(f"unknown options: {sorted(unknown)}")
    kinds = {f.name: type(getattr(given.detection, f.name)) for f in fields(given.detection)}
    return replace(given, detection=replace(given.detection, **{OPTIONS[k]: True if v == "" else kinds[OPTIONS[k]](v) for k, v in options.items()}))
