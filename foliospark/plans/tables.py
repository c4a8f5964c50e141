"""The derived tables of the batch data flow.

Cleaned tables, features and predictions are stored when first asked for, since several later steps read each of them.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.operators import cleaning, features, quality, recommend, scoring
from foliospark.sources.tables import stage


@dataclass(frozen=True)
class Inputs:
    """Raw tables and the day that "today" means."""

    books: DataFrame
    interactions: DataFrame
    authors: DataFrame
    name_genders: DataFrame
    as_of: dt.date


class Derived:
    """Cleaned tables, features, splits and predictions; nothing runs until one is asked for."""

    def __init__(self, inputs: Inputs):
        self.raw = inputs

    @cached_property
    def books(self) -> DataFrame:
        return stage(cleaning.clean_books(self.raw.books), "books")

    @cached_property
    def interactions(self) -> DataFrame:
        return stage(cleaning.of_known_books(cleaning.clean_interactions(self.raw.interactions), self.books), "interactions")

    @cached_property
    def features(self) -> DataFrame:
        return stage(features.build_features(self.books, self.interactions, self.raw.as_of), "features")

    @cached_property
    def normalised(self) -> DataFrame:
        return features.normalise(self.features)

    @cached_property
    def split(self) -> DataFrame:
        return features.with_split(self.features)

    @cached_property
    def gender_map(self) -> DataFrame:
        return stage(recommend.author_gender_map(self.raw.authors, self.raw.name_genders), "gender_map")

    @cached_property
    def rated(self) -> DataFrame:
        return self.features.where(F.col("rating") > 0)

    @cached_property
    def mean_model(self) -> scoring.MeanModel:
        return scoring.fit_means(self.rated)

    @cached_property
    def predictions(self) -> DataFrame:
        """Scored rated rows with the slicing columns."""
        return stage(scoring.prediction_table(scoring.score(self.rated, self.mean_model), self.books, self.gender_map), "predictions")

    @cached_property
    def candidates(self) -> DataFrame:
        """Predictions of three scorers, told apart by ``model_name``: global mean, book mean, mean deviations."""
        model = self.mean_model
        base = self.predictions
        means = base.join(model.books, "book_id", "left").crossJoin(F.broadcast(model.overall))
        entries = F.array(*[F.struct(F.lit(n).alias("model_name"), c.alias("_p")) for n, c in (
            ("global_mean", F.col("mu")), ("book_mean", F.col("book_mean")), ("mean_deviation", F.col("predicted_rating")))])
        wide = means.select(*base.columns, F.inline(entries))
        error = F.col("actual_rating") - F.col("_p")
        return wide.withColumns({"predicted_rating": F.col("_p"), "error": error, "absolute_error": F.abs(error)}).drop("_p")


def validated(raw: Inputs) -> Derived:
    """Run the quality gates around cleaning and return the derived tables; a failed gate raises."""
    derived = Derived(raw)
    quality.gate(quality.rule_report(raw.books, "source books", quality.source_book_rules()))
    quality.gate(quality.rule_report(raw.interactions, "source interactions", quality.source_interaction_rules()))
    quality.gate(quality.rule_report(derived.books, "cleaned books", quality.cleaned_book_rules()))
    quality.gate(quality.rule_report(derived.interactions, "cleaned interactions", quality.cleaned_interaction_rules()))
    return derived
