"""Adapters by name, each with the options that its configuration may have."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


class ConfigError(ValueError):
    """A configuration that breaks its adapter's options; says all that is wrong."""


@dataclass(frozen=True)
class Option:
    """What a setting may be: its type, its value where it is not given, and its bounds (``above`` is exclusive)."""

    kind: type
    default: object = None
    least: float | None = None
    most: float | None = None
    above: float | None = None
    required: bool = False

    def issue(self, value: object) -> str | None:
        number = self.kind in (int, float)
        fits = isinstance(value, (int, float) if self.kind is float else self.kind) and not (number and isinstance(value, bool))
        if not fits:
            return f"is no {self.kind.__name__}"
        if self.kind is list and not all(isinstance(x, str) for x in value):
            return "holds other than texts"
        if number and ((self.least is not None and value < self.least) or (self.most is not None and value > self.most) or (self.above is not None and value <= self.above)):
            return f"is out of range: {value}"
        return None


# The options of all feeds of postings, and of all statistics.
SOURCE = {"enabled": Option(bool, True), "keywords": Option(list, []), "countries": Option(list, []), "max_results": Option(int, 500, least=1)}
STATISTICS = {"enabled": Option(bool, True), "countries": Option(list, []), "isco_codes": Option(list, []), "min_interval_hours": Option(int, 0, least=0), "url": Option(str)}
#: Options of this engine beside: files in the place of an endpoint, another endpoint, and the run's time.
OWN = {"path": Option(str), "slug": Option(str), "base_url": Option(str), "now": Option(str)}


def checked(name: str, options: dict[str, Option], values: dict) -> dict:
    """``values`` with defaults filled in. Unknown keys are left out, as they may be another version's; null counts as not given."""
    given = {k: v for k, v in values.items() if v is not None}
    wrong = [f"{k} {told}" for k, o in options.items() if k in given and (told := o.issue(given[k]))]
    wrong += [f"{k} is missing" for k, o in options.items() if o.required and k not in given]
    if wrong:
        raise ConfigError(f"{name}: " + ", ".join(wrong))
    return {k: given.get(k, o.default) for k, o in options.items()}


@dataclass(frozen=True)
class Adapter:
    """A named reader: (spark, configuration) -> rows of its contract."""

    name: str
    read: Callable[..., DataFrame]
    options: dict[str, Option] = field(default_factory=dict)

    def config(self, values: dict) -> dict:
        return checked(self.name, self.options, values)

    def __call__(self, spark: SparkSession, values: dict, **given) -> DataFrame:
        return self.read(spark, self.config(values), **given)


class Registry(dict):
    """Adapters of one kind; a name may be taken once."""

    def register(self, name: str, options: dict[str, Option] | None = None):
        """Make a function (spark, config) -> DataFrame the adapter ``name``."""

        def take(f):
            if name in self:
                raise ValueError(f"adapter {name} is registered already")
            if not callable(f):
                raise TypeError(f"adapter {name} is no function")
            self[name] = Adapter(name, f, options or {})
            return f

        return take

    def names(self) -> list[str]:
        return sorted(self)
