"""Chainable feature recipes."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feldspark.functions import expressions as X
from feldspark.functions.missing import number


@dataclass(frozen=True)
class _Step:
    """One new column; ``needs`` names the global statistics its expression takes."""

    inputs: tuple[str, ...]
    output: str
    build: Callable[[list[Column], dict], Column]
    needs: tuple[str, ...] = ()


_STATISTICS = {"min": F.min, "max": F.max, "mean": F.avg, "std": F.stddev_samp}


def resolve(columns: Sequence[str], name: str) -> str:
    """``name`` itself, or the same feature with or without the ``_norm`` suffix."""
    plain = name.removesuffix("_norm")
    for candidate in (name, plain, f"{plain}_norm"):
        if candidate in columns:
            return candidate
    raise ValueError(f"Missing feature: {name}")


@dataclass
class Recipe:
    """Feature steps applied in order. Means, deviations and ranges are those of the whole table."""

    steps: list = field(default_factory=list)

    def add_interaction(self, first: str, second: str, output: str | None = None) -> Recipe:
        name = output or f"{first}_{second}_interaction"
        return self._add((first, second), name, lambda c, s: X.interaction(*c))

    def add_polynomial(self, feature: str, degree: int = 2, output: str | None = None) -> Recipe:
        return self._add((feature,), output or f"{feature}_poly_{degree}", lambda c, s: X.polynomial(c[0], degree))

    def add_log(self, feature: str, output: str | None = None, epsilon: float = 1e-8) -> Recipe:
        return self._add((feature,), output or f"{feature}_log", lambda c, s: X.log_magnitude(c[0], epsilon))

    def add_binning(
        self, feature: str, bins: int = 10, output: str | None = None, labels: Sequence[str] | None = None
    ) -> Recipe:
        """Equal-width, right-closed bins: the bin number, or its label."""
        if labels is not None and len(labels) != bins:
            raise ValueError("one label per bin is needed")

        def build(c: list[Column], s: dict) -> Column:
            if s["min"] is None:
                return F.lit(None).cast("string" if labels else "int")
            index = X.bin_index(c[0], X.bin_edges(s["min"], s["max"], bins))
            # ``get`` gives NULL for a missing bin; ``element_at`` may give some label
            return F.get(F.array(*[F.lit(x) for x in labels]), index) if labels else index

        return self._add((feature,), output or f"{feature}_binned", build, ("min", "max"))

    def add_standardization(self, feature: str, output: str | None = None) -> Recipe:
        name = output or f"{feature}_standardized"
        return self._add((feature,), name, lambda c, s: X.standardize(c[0], s["mean"], s["std"]), ("mean", "std"))

    def add_expression(self, output: str, text: str) -> Recipe:
        """A named SQL expression over the columns made so far."""
        self.steps.append((output, text))
        return self

    def add_batches(self, function: Callable[[Iterator], Iterator], schema: str) -> Recipe:
        """A function over iterators of pandas batches, for what SQL cannot say."""
        self.steps.append((function, schema))
        return self

    def _add(self, inputs, output, build, needs=()) -> Recipe:
        self.steps.append(_Step(inputs, output, build, needs))
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """Add the columns. All statistics that can be taken together cost one pass."""
        waiting = list(self.steps)
        while waiting:
            ready: list = []
            blocked: set[str] = set()
            wanted: dict[tuple[str, str], Column] = {}
            staged = df
            for step in waiting:
                if not isinstance(step, _Step):
                    # free-form steps may read any column made before them
                    if blocked:
                        break
                    staged = _free_form(staged, step)
                    ready.append(step)
                    continue
                measured = {name for name, _ in wanted}
                if blocked & {*step.inputs, step.output} or step.output in measured:
                    break
                names = [resolve(staged.columns, n) for n in step.inputs]
                if step.needs:
                    for stat in step.needs:
                        wanted[names[0], stat] = _STATISTICS[stat](number(staged, names[0]))
                    blocked.add(step.output)
                else:
                    staged = staged.withColumn(step.output, step.build([number(staged, n) for n in names], {}))
                ready.append(step)
            known = _measure(staged, wanted)
            for step in ready:
                if isinstance(step, _Step):
                    names = [resolve(df.columns, n) for n in step.inputs]
                    stats = {stat: known[names[0], stat] for stat in step.needs}
                    df = df.withColumn(step.output, step.build([number(df, n) for n in names], stats))
                else:
                    df = _free_form(df, step)
            waiting = waiting[len(ready):]
        return df

    fit_transform = transform


def _free_form(df: DataFrame, step: tuple) -> DataFrame:
    head, tail = step
    return df.withColumn(head, F.expr(tail)) if isinstance(head, str) else df.mapInPandas(head, tail)


def _measure(df: DataFrame, wanted: dict[tuple[str, str], Column]) -> dict[tuple[str, str], float]:
    if not wanted:
        return {}
    row = df.agg(*[e.alias(f"s{i}") for i, e in enumerate(wanted.values())]).first()
    return dict(zip(wanted, row, strict=True))


def default_recipe(interactions: bool = True) -> Recipe:
    """Interaction and squares of the first two features, ln(|x|+1) of the other two."""
    recipe = Recipe()
    if interactions:
        recipe.add_interaction("feature_1_norm", "feature_2_norm")
    recipe.add_polynomial("feature_1_norm").add_polynomial("feature_2_norm")
    return recipe.add_log("feature_3", epsilon=1.0).add_log("feature_4", epsilon=1.0)


def fill_interaction(
    df: DataFrame, first: str = "feature_1", second: str = "feature_2", output: str = "feature_interaction"
) -> DataFrame:
    """The given interaction, or the product where it is missing."""
    product = X.interaction(number(df, first), number(df, second))
    given = [number(df, output)] if output in df.columns else []
    return df.withColumn(output, F.coalesce(*given, product))
