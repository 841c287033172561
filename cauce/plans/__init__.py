from cauce.plans.jobs import StageResult, run_all, run_clean, run_enrich, run_ingest

__all__ = ["StageResult", "run_all", "run_clean", "run_enrich", "run_ingest"]
