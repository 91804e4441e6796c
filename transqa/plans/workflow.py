"""The whole workflow as materialised stages."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transqa.config import Settings
from transqa.operators import compare, evalset, observe, routing, scoring, translate
from transqa.operators.extract import extract_text, with_text
from transqa.operators.infer import AnswerStore, ClientFactory, Inference
from transqa.sources.tables import StageTables

PARSED = "parsed_documents"
PHASE_ONE = "translations_batch"
PHASE_TWO = "translations_with_backtrans"
EVALUATION = "translation_scores"
FINAL = "translation_final_v2"
DATASET = "translation_eval_dataset"
RUNS = "runs"
SCORER_METRICS = ("pass_rate", "scored", "passed", "errors")
COMPARISON_METRICS = (
    "num_documents", "estimated_total_tokens", "translation_duration_s", "avg_duration_per_doc_s",
    "tokens_per_second",
)


@dataclass
class Workflow:
    """Stages of one schema's tables, each written once and read by the next."""

    tables: StageTables
    client_factory: ClientFactory
    settings: Settings = field(default_factory=Settings)
    answers: str = "answers"
    clock: observe.StageClock = field(default_factory=observe.StageClock)
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)

    @property
    def inference(self) -> Inference:
        return self._inference(self.answers)

    def _inference(self, answers: str) -> Inference:
        s = self.settings
        return Inference(
            self.client_factory,
            AnswerStore(self.tables, answers, s.reuse_days),
            s.parallelism,
            s.threads_per_task,
            s.call_rounds,
            s.hot_rows,
        )

    def parse(self, parsed: DataFrame) -> DataFrame:
        """Extract text from parsed documents."""
        with self.clock.stage("parse"):
            return self.tables.replace(extract_text(parsed), PARSED)

    def phase_one(self, documents: DataFrame | None = None) -> DataFrame:
        """Detect and translate every document."""
        source = self.tables.read(PARSED) if documents is None else documents
        with self.clock.stage("phase_one"):
            names = self.settings.identity(source.columns)
            kept = with_text(source, self.settings.min_chars).select(*names, "extracted_text")
            done = translate.detect_and_translate(kept, self.inference, self.settings)
            done = done.withColumn(translate.NEEDS_BACK, translate.needs_back_translation())
            return self.tables.replace(done, PHASE_ONE, (translate.NEEDS_BACK,))

    def phase_two(self) -> DataFrame:
        """Back-translate what phase one wrote."""
        with self.clock.stage("phase_two"):
            done = translate.back_translate(
                self.tables.read(PHASE_ONE), self.inference, self.settings
            )
            return self.tables.replace(
                done.drop(translate.NEEDS_BACK), PHASE_TWO, buckets=self._buckets(PHASE_ONE)
            )

    def evaluate(self, scorers: list[scoring.Scorer] | None = None) -> DataFrame:
        """Score the translations; the result holds keys, language, verdicts and status."""
        chosen = scorers or scoring.default_scorers(self.settings)
        records = scoring.evaluation_records(self.tables.read(PHASE_TWO), self.settings)
        with self.clock.stage("evaluate"):
            names = [*self.settings.identity(records.select("inputs.*").columns), "detected_language"]
            keep = [F.col(f"inputs.{name}").alias(name) for name in names]
            evaluated = scoring.evaluate(records, chosen, self.inference, keep)
            routed = routing.route(evaluated, [*names, *[s.name for s in chosen]])
            scores = self.tables.replace(routed, EVALUATION, buckets=self._buckets(PHASE_TWO))
        self._log_evaluation(scores, [s.name for s in chosen])
        return scores

    def _log_evaluation(self, scores: DataFrame, scorers: list[str]) -> None:
        """Parameters of the evaluation and the counts and rates of each scorer."""
        metrics = scoring.scorer_metrics(scoring.tidy_scores(scores, scorers, []))
        self._log(
            "evaluation",
            {
                "llm_endpoint": self.settings.endpoints.judge,
                "num_documents": scores.count(),
                "pipeline_version": self.settings.pipeline_version,
            },
            observe.metric_rows(
                metrics, self.run_id, F.concat(F.lit("evaluation_"), "scorer"), SCORER_METRICS
            ),
        )

    def _log(self, name: str, params: dict[str, object], metrics: DataFrame) -> None:
        rows = observe.run_rows(self.tables.spark, self.run_id, name, params)
        self.tables.create_or_load(RUNS, observe.RUNS_SCHEMA)
        self.tables.append(rows.unionByName(metrics), RUNS)

    def _buckets(self, table: str) -> tuple[int, str]:
        """Buckets by key for the tables the final join meets: one per ``rows_per_bucket`` rows.

        Phase two holds the rows of phase one and the evaluation those of phase two, so
        both get the same count and their join moves neither side.
        """
        rows = self.tables.read(table).count()
        return max(1, -(-rows // self.settings.rows_per_bucket)), self.settings.key

    def finalize(self) -> DataFrame:
        """Translations with status and rationales, joined bucket by bucket: no text moves."""
        final = routing.attach_results(
            self.tables.read(PHASE_TWO), self.tables.read(EVALUATION), self.settings.key
        )
        with self.clock.stage("finalize"):
            return self.tables.replace(final, FINAL)

    def grow_dataset(self) -> DataFrame:
        """Add the current results to the evaluation dataset."""
        cases = evalset.evaluation_cases(self.tables.read(PHASE_TWO), self.settings)
        with self.clock.stage("dataset"):
            return evalset.upsert_cases(self.tables, DATASET, cases)

    def compare(self, documents: DataFrame | None = None, count: int | None = 3) -> DataFrame:
        """Usage, speed and pass rates per endpoint, over one materialised sample.

        The comparison keeps answers of its own, so that every endpoint is really
        called and timed.
        """
        inference = self._inference(f"comparison_{uuid.uuid4().hex[:8]}")
        source = self.tables.read(PARSED) if documents is None else documents
        chosen = compare.sample_documents(source, self.settings, count)
        sample = self.tables.replace(chosen, "comparison_sample")
        translated = self.tables.replace(
            compare.translate_by_endpoint(sample, inference, self.settings),
            "comparison_translations",
        )
        asked = translate.translate_task(self.settings, endpoint=F.col("endpoint"))
        spans = inference.store.for_tasks([asked])
        report = compare.throughput(
            compare.token_usage(translated), compare.endpoint_durations(spans)
        )
        quality = compare.quality_by_endpoint(translated, inference, self.settings)
        rates = quality.groupBy("endpoint").pivot(
            "scorer", [scoring.COMPLETENESS, scoring.GUIDELINES]
        ).agg(F.first("pass_rate"))
        compared = self.tables.replace(report.join(rates, "endpoint", "left"), "comparison")
        self._log(
            "comparison",
            {
                "endpoints": ",".join(self.settings.endpoints.comparison),
                "num_documents": sample.count(),
                "pipeline_version": self.settings.pipeline_version,
            },
            observe.metric_rows(
                compared, self.run_id, F.concat(F.lit("comparison_"), "endpoint"),
                [*COMPARISON_METRICS, scoring.COMPLETENESS, scoring.GUIDELINES],
            ),
        )
        return compared

    def log_run(self, name: str, documents: int, baseline_s: float | None = None) -> DataFrame:
        """Store this run's parameters and stage times."""
        s = self.settings
        params = {
            "llm_endpoint": s.endpoints.translate,
            "num_documents": documents,
            "pipeline_version": s.pipeline_version,
        }
        rows = observe.run_rows(
            self.tables.spark, self.run_id, name, params, self.clock.metrics(baseline_s)
        )
        self.tables.create_or_load(RUNS, observe.RUNS_SCHEMA)
        self.tables.append(rows, RUNS)
        return self.tables.read(RUNS)

    def run(self, documents: DataFrame | None = None) -> DataFrame:
        """Both phases, evaluation and the final table."""
        self.phase_one(documents)
        self.phase_two()
        self.evaluate()
        return self.finalize()
