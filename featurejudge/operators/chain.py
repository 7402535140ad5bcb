"""A chain of preparation, resampling and a classifier, as one fitted model.

``ColumnGroups`` prepares columns group by group; its model is a set of
fitted Column expressions, so applying it is one projection.  ``Oversample``
balances the classes while a ``Chain`` is fitted and does nothing to rows that
are only scored.  All parts are saved and loaded with the fitted pipeline.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurejudge.functions.columns import sanitize_name
from featurejudge.operators import encode, fit, oversample
from featurejudge.session import cut_lineage

FILLS = ("median", "most_frequent", "zero")
STEPS = (*FILLS, "scale", "onehot")



class ColumnGroups(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Preparation by column group.  ``groups``: (name, columns, steps), the
    steps in order, each group at most one of

    * ``median`` (exact, then 0), ``most_frequent`` (ties: smallest), ``zero``:
      what nulls become;
    * ``scale``: minus the mean, by the population standard deviation, of the
      filled column; a constant column becomes 0;
    * ``onehot``: a 0/1 column a value (null and new values: all 0).

    Statistics come from the rows given to ``fit`` alone: one sketch, one count
    and one value pass for all medians, one pass for all modes, one for all
    moments, one for all vocabularies.  ``remainder``: "passthrough" keeps the
    other columns in front, "drop" only those of ``keep``."""

    groups = Param(Params._dummy(), "groups", "JSON of (name, columns, steps)", TypeConverters.toString)
    remainder = Param(Params._dummy(), "remainder", "passthrough or drop", TypeConverters.toString)
    keep = Param(Params._dummy(), "keep", "JSON of columns that always stay", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, groups: Sequence = (), remainder: str = "passthrough", keep: Sequence[str] = ()):
        super().__init__()
        seen: set[str] = set()
        for name, cols, steps in groups:
            if unknown := [s for s in steps if s not in STEPS]:
                raise ValueError(f"group {name}: unknown steps {unknown}")
            if sum(s in FILLS for s in steps) > 1 or len(set(steps)) < len(steps) or {"scale", "onehot"} <= set(steps):
                raise ValueError(f"group {name}: steps {list(steps)} do not go together")
            if twice := seen & set(cols):
                raise ValueError(f"group {name}: {sorted(twice)} are in another group")
            seen |= set(cols)
        if remainder not in ("passthrough", "drop"):
            raise ValueError(f"remainder {remainder!r}")
        self._set(groups=json.dumps([[n, list(c), list(s)] for n, c, s in groups]), remainder=remainder, keep=json.dumps(list(keep)))

    def _fit(self, dataset: DataFrame) -> ColumnGroupsModel:
        groups = json.loads(self.getOrDefault(self.groups))

        def having(step):
            return [c for _, cols, steps in groups if step in steps for c in cols]
        fills = {**fit.fit_medians(dataset, having("median")), **(fit.fit_modes(dataset, m) if (m := having("most_frequent")) else {})}
        # a column without any value is filled with 0
        kinds = {f.name: f.dataType for f in dataset.schema.fields}
        for c in having("median") + having("zero"):
            fills[c] = 0.0 if fills.get(c) is None else fills[c]
        for c in having("most_frequent"):
            if fills[c] is None and isinstance(kinds[c], T.NumericType):
                fills[c] = 0
        if odd := [c for c, v in fills.items() if not isinstance(v, (int, float, str, bool, type(None)))]:
            raise TypeError(f"columns {odd}: only numbers, texts and booleans can be filled")
        filled = dataset.withColumns({c: _filled(c, fills[c]) for c in fills})
        scaled = having("scale")
        moments = fit.fit_moments(filled, scaled) if scaled else {}
        vocab = encode.fitted_vocabularies(filled, having("onehot")) if having("onehot") else {}
        fitted = [[name, [[c, fills.get(c), list(moments[c]) if c in moments else None, list(vocab[c]) if c in vocab else None,
                           c in fills] for c in cols]] for name, cols, _ in groups]
        model = ColumnGroupsModel()
        return model._set(fitted=json.dumps(fitted), remainder=self.getOrDefault(self.remainder), keep=self.getOrDefault(self.keep))


def _filled(name: str, value) -> Column:
    col = F.col(f"`{name}`")
    return col if value is None else F.coalesce(col, F.lit(value))


class ColumnGroupsModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted ``ColumnGroups``: a projection."""

    fitted = Param(Params._dummy(), "fitted", "JSON of the fitted groups", TypeConverters.toString)
    remainder = Param(Params._dummy(), "remainder", "passthrough or drop", TypeConverters.toString)
    keep = Param(Params._dummy(), "keep", "JSON of columns that always stay", TypeConverters.toString)

    def _columns(self) -> list[tuple[str, Column]]:
        out = []
        for _, cols in json.loads(self.getOrDefault(self.fitted)):
            for name, fill, moments, vocab, filled in cols:
                value = _filled(name, fill) if filled else F.col(f"`{name}`")
                if vocab is not None:
                    out += [(sanitize_name(f"{name}_{v}"), F.when(value == F.lit(v), 1).otherwise(0)) for v in vocab]
                elif moments is not None:
                    mean, std = moments
                    known = mean is not None and std
                    out.append((name, (value - F.lit(mean)) / F.lit(std) if known else F.when(value.isNotNull(), 0.0)))
                else:
                    out.append((name, value))
        return out

    @property
    def features(self) -> list[str]:
        """Names of the prepared columns, in the order of the groups."""
        return [name for name, _ in self._columns()]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        grouped = {c[0] for _, cols in json.loads(self.getOrDefault(self.fitted)) for c in cols}
        keep = json.loads(self.getOrDefault(self.keep))
        made = self._columns()
        names = {n for n, _ in made}
        rest = [c for c in dataset.columns if c in keep or c not in grouped and self.getOrDefault(self.remainder) == "passthrough"]
        if clash := names & set(rest):
            raise ValueError(f"prepared columns {sorted(clash)} are also kept as they are")
        return dataset.select(*[F.col(f"`{c}`") for c in rest], *[c.alias(n) for n, c in made])


class Oversample(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Classes of equal size by synthetic rows (``oversample.smote``), for a
    ``Chain`` that is being fitted; ``transform`` changes nothing."""

    key = Param(Params._dummy(), "key", "unique column", TypeConverters.toString)
    label = Param(Params._dummy(), "label", "class column", TypeConverters.toString)
    vec = Param(Params._dummy(), "vec", "vector column", TypeConverters.toString)
    k = Param(Params._dummy(), "k", "neighbours", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, key: str = "id", label: str = "target", vec: str = "features", k: int = 5, seed: int = 42):
        super().__init__()
        self._set(key=key, label=label, vec=vec, k=k, seed=seed)

    def resample(self, dataset: DataFrame) -> DataFrame:
        """(key, label, vec): the rows of ``dataset`` and the synthetic ones, whose key is null."""
        key, label, vec = (self.getOrDefault(p) for p in (self.key, self.label, self.vec))
        rows = dataset.select(key, label, vector_to_array(vec).alias(vec))
        out = oversample.smote(rows, key, label, vec, self.getOrDefault(self.k), self.getOrDefault(self.seed))
        return out.select(key, label, array_to_vector(vec).alias(vec))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset


class Chain(Pipeline):
    """A ``Pipeline`` some of whose stages resample: they change the rows that
    later stages are fitted on, and are part of the fitted ``PipelineModel``
    as what they are when scoring, the identity."""

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        fitted, stages = [], self.getStages()
        last = max((i for i, s in enumerate(stages) if isinstance(s, Estimator)), default=-1)
        for i, stage in enumerate(stages):
            model = stage.fit(dataset) if isinstance(stage, Estimator) else stage
            fitted.append(model)
            if i < last:
                # the estimator after it reads the resampled rows several times
                dataset = cut_lineage(stage.resample(dataset)) if hasattr(stage, "resample") else model.transform(dataset)
        return PipelineModel(fitted)


def resampled(chain: Chain, dataset: DataFrame) -> DataFrame:
    """What the last estimator of ``chain`` is fitted on."""
    stages = chain.getStages()
    last = max((i for i, s in enumerate(stages) if isinstance(s, Estimator)), default=len(stages))
    for stage in stages[:last]:
        if hasattr(stage, "resample"):
            dataset = stage.resample(dataset)
        else:
            dataset = (stage.fit(dataset) if isinstance(stage, Estimator) else stage).transform(dataset)
    return dataset
