"""Models that say what they read. The order of a build follows from that, not from a list of calls.

A model names the models and sources it reads; a model written in SQL names them in braces, as in
``SELECT * FROM {stg_matches}``, and they are read off the text. Models that do not wait for each
other are made side by side, so their Spark jobs share the cluster.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from graphlib import CycleError, TopologicalSorter
from string import Formatter

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from matchlake.sources.tables import Namespaces, point, publish

SIDE_BY_SIDE = 4  # models made at a time


class ModelError(ValueError):
    """Models that do not fit together: an unknown or repeated name, or a circle."""


@dataclass(frozen=True)
class Model:
    name: str
    layer: str
    make: Callable[[Step], object]
    reads: tuple[str, ...] = ()


@dataclass(frozen=True)
class Step:
    """What a model is given while it is made."""

    spark: SparkSession
    namespaces: Namespaces
    model: Model
    known: Mapping[str, str]  # table of every model and source
    results: Mapping[str, object]  # what finished models returned

    @property
    def table(self) -> str:
        return self.namespaces.table(self.model.layer, self.model.name)

    @property
    def path(self) -> str | None:
        return self.namespaces.path(self.model.layer, self.model.name)

    def _declared(self, name: str) -> str:
        if name not in self.model.reads:
            raise ModelError(f"{self.model.name} reads {name} without declaring it")
        return name

    def ref(self, name: str) -> str:
        """Table name of a model or source that this one declares."""
        return self.known[self._declared(name)]

    def result(self, name: str):
        return self.results[self._declared(name)]


def names_in(text: str) -> tuple[str, ...]:
    """Names in braces, once each, as they come; doubled braces stand for themselves."""
    return tuple(dict.fromkeys(name for _, name, _, _ in Formatter().parse(text) if name is not None))


def sql_model(
    name: str, layer: str, text: str, materialized: str = "view", partition_by: Sequence[str] = ()
) -> Model:
    """A model written in SQL, published as a view or as a table."""
    if materialized not in ("view", "table"):
        raise ModelError(f"{name}: materialized is view or table, not {materialized}")

    def make(step: Step) -> None:
        query = text.format(**{n: step.ref(n) for n in step.model.reads})
        if materialized == "view":
            point(step.spark, step.table, query)
        else:
            publish(step.spark.sql(query), step.table, step.path, partition_by)

    return Model(name, layer, make, names_in(text))


def sorter(models: Iterable[Model], sources: Iterable[str] = ()) -> TopologicalSorter:
    """A prepared sorter of model names. Unknown and repeated names and circles are errors,
    found before anything is built."""
    models, outside = list(models), set(sources)
    names = [m.name for m in models]
    for name in names:
        if names.count(name) > 1 or name in outside:
            raise ModelError(f"{name} is declared more than once")
    for model in models:
        for read in model.reads:
            if read not in outside and read not in names:
                raise ModelError(f"{model.name} reads {read}, which is no model and no source")
    order = TopologicalSorter({m.name: [r for r in m.reads if r not in outside] for m in models})
    try:
        order.prepare()
    except CycleError as circle:
        raise ModelError("models read each other: " + " -> ".join(circle.args[1])) from None
    return order


def make_models(
    spark: SparkSession,
    namespaces: Namespaces,
    models: Sequence[Model],
    sources: Mapping[str, str] | None = None,
    side_by_side: int = SIDE_BY_SIDE,
) -> dict[str, object]:
    """Make every model after those it reads; what each returned, by name.

    When one fails, those already running are waited for, no other is started and the first
    error is raised.
    """
    sources = dict(sources or {})
    order = sorter(models, sources)
    by_name = {m.name: m for m in models}
    known = sources | {m.name: namespaces.table(m.layer, m.name) for m in models}
    results: dict[str, object] = {}
    running: dict[Future, str] = {}
    failed: BaseException | None = None
    # job groups and other local properties of the caller hold for its models
    inherit = inheritable_thread_target(spark) if spark else lambda make: make
    with ThreadPoolExecutor(side_by_side) as pool:
        while order.is_active() and not failed:
            for name in order.get_ready():
                step = Step(spark, namespaces, by_name[name], known, results)
                running[pool.submit(inherit(by_name[name].make), step)] = name
            for done in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(done)
                if done.exception():
                    failed = failed or done.exception()
                else:
                    results[name] = done.result()
                    order.done(name)
        if failed:
            for waiting in running:
                waiting.cancel()
    if failed:
        raise failed
    return results
