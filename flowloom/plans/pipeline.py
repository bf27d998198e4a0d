"""Pipelines: named stages that follow each other, composed into DataFrames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from flowloom.operators import aggregate, conntrack, enrich, filters, generic, metrics, topk, walk

#: Transforms by the type that a stage's configuration names.
TRANSFORMS: dict[str, Callable[..., DataFrame]] = {
    "none": lambda df: df, "generic": generic.generic, "filter": filters.transform_filter, "aggregates": aggregate.aggregates, "timebased": topk.timebased,
    "connections": conntrack.connections, "track": walk.track, "subnet_label": enrich.add_subnet_label, "location": enrich.add_location, "service": enrich.add_service,
    "kubernetes": enrich.add_kubernetes, "counter": metrics.counter, "gauge": metrics.gauge, "histogram": metrics.histogram,
}


class Pipeline:
    """stages: [{name, follows?, type, params?, sink?}]. A stage without ``follows`` reads the input; several may follow
    one (fork), and a stage may follow several (their rows are united). A stage marked ``sink`` is a result."""

    def __init__(self, stages: list[dict]):
        known = {"name", "follows", "type", "params", "sink"}
        names = [s["name"] for s in stages]
        if len(set(names)) != len(names):
            raise ValueError("two stages have the same name")
        for s in stages:
            if set(s) - known:
                raise ValueError(f"unknown keys in stage {s['name']}: {sorted(set(s) - known)}")
            if s["type"] not in TRANSFORMS and not callable(s["type"]):
                raise ValueError(f"unknown type {s['type']!r}")
        followed = set()
        for s in stages:
            for f in self._follows(s):
                if f not in names:
                    raise ValueError(f"stage {s['name']} follows {f}, which is not there")
                followed.add(f)
        for s in stages:
            if s.get("sink") and s["name"] in followed:
                raise ValueError(f"sink {s['name']} cannot be followed")
            if not s.get("sink") and s["name"] not in followed:
                raise ValueError(f"nothing follows {s['name']}, and it is no sink")
        self.stages = stages

    @staticmethod
    def _follows(stage: dict) -> list[str]:
        f = stage.get("follows") or []
        return [f] if isinstance(f, str) else list(f)

    def run(self, df: DataFrame) -> dict[str, DataFrame]:
        """The sinks' DataFrames by name; nothing runs before they are read."""
        done: dict[str, DataFrame] = {}
        left = list(self.stages)
        while left:
            ready = [s for s in left if all(f in done for f in self._follows(s))]
            if not ready:
                raise ValueError("the stages follow each other in a circle")
            for s in ready:
                inputs = [done[f] for f in self._follows(s)] or [df]
                rows = inputs[0]
                for other in inputs[1:]:
                    rows = rows.unionByName(other, allowMissingColumns=True)
                step = s["type"] if callable(s["type"]) else TRANSFORMS[s["type"]]
                done[s["name"]] = step(rows, **s.get("params", {}))
                left.remove(s)
        return {s["name"]: done[s["name"]] for s in self.stages if s.get("sink")}


class Flow:
    """The fluent form: each method adds a stage to a DataFrame; a Flow can be continued in several ways."""

    def __init__(self, df: DataFrame):
        self.df = df

    def then(self, step: Callable[..., DataFrame], *args, **kw) -> Flow:
        return Flow(step(self.df, *args, **kw))

    def __getattr__(self, name: str):
        if name not in TRANSFORMS:
            raise AttributeError(name)
        return lambda *args, **kw: self.then(TRANSFORMS[name], *args, **kw)
