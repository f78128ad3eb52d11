from labelgap.plans.chain import Done, Stage, StageFailed, run_stages, source_fingerprint, stage_report
from labelgap.plans.config import Config
from labelgap.plans.detector import detector_model, effect_of_augmentation, risk_scores, synthesis_and_detector
from labelgap.plans.gap import gap_analysis, gap_chain, gap_tables, merge_nutrients
from labelgap.plans.labels import draft_labels, report_labels
from labelgap.plans.preprocessing import preprocess, preprocess_chain, preprocessing_stages
from labelgap.plans.validation import validate

__all__ = [
    "Config",
    "Done",
    "Stage",
    "StageFailed",
    "detector_model",
    "draft_labels",
    "effect_of_augmentation",
    "gap_analysis",
    "gap_chain",
    "gap_tables",
    "merge_nutrients",
    "preprocess",
    "preprocess_chain",
    "preprocessing_stages",
    "report_labels",
    "risk_scores",
    "run_stages",
    "source_fingerprint",
    "stage_report",
    "synthesis_and_detector",
    "validate",
]
