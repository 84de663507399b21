"""The table that maps dotted metric names to metrics and labels; first rule first."""

from __future__ import annotations

#: Name pattern (a star is one part), metric, names of the stars.
RULES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("pdf.pipeline.*.completed", "pdf_pipeline_completed_total", ("status",)),
    ("pdf.pipeline.*.duration", "pdf_pipeline_duration_seconds", ("stage",)),
    ("pdf.dag.*.*.duration", "pdf_dag_duration_seconds", ("dag_name", "task_name")),
    ("pdf.dag.*.tasks.active", "pdf_active_tasks_total", ("dag_name",)),
    ("pdf.dag.*.tasks.completed", "pdf_tasks_completed_total", ("dag_name",)),
    ("pdf.dag.*.errors.*", "pdf_pipeline_errors_total", ("stage", "error_type")),
    ("pdf.quality.score.*", "pdf_quality_score", ("validation_level",)),
    ("pdf.quality.*.corrections", "pdf_quality_corrections_total", ("validation_level",)),
    ("pdf.quality.overall.score", "pdf_quality_overall_score", ()),
    ("vllm.requests.*.duration", "vllm_request_duration_seconds", ("operation",)),
    ("vllm.requests.*", "vllm_requests_total", ("operation",)),
    ("vllm.model.*.tokens.input", "vllm_input_tokens_total", ("model",)),
    ("vllm.model.*.tokens.output", "vllm_output_tokens_total", ("model",)),
    ("vllm.gpu.utilization", "vllm_gpu_utilization_percent", ()),
    ("docprocessor.*.requests", "docprocessor_requests_total", ("component",)),
    ("docprocessor.ocr.*.accuracy", "docprocessor_ocr_accuracy_percent", ("engine",)),
    ("docprocessor.*.processing.time", "docprocessor_processing_seconds", ("component",)),
    ("translator.*.requests", "translator_requests_total", ("target_language",)),
    ("translator.*.quality.score", "translator_quality_score", ("target_language",)),
    ("pdf.files.processed.*", "pdf_files_processed_total", ("target_language",)),
    ("pdf.files.size.bytes", "pdf_file_size_bytes", ()),
    ("pdf.files.pages", "pdf_file_pages_total", ()),
    ("flask.api.*.requests", "flask_api_requests_total", ("endpoint",)),
    ("flask.api.*.duration", "flask_api_duration_seconds", ("endpoint",)),
    ("flask.api.*.errors.*", "flask_api_errors_total", ("endpoint", "error_code")),
    ("pdf.batch.*.files", "pdf_batch_files_total", ("batch_id",)),
    ("pdf.batch.*.duration", "pdf_batch_duration_seconds", ("batch_id",)),
    ("system.*.cpu.usage", "system_cpu_usage_percent", ("service",)),
    ("system.*.memory.usage", "system_memory_usage_bytes", ("service",)),
    ("system.*.disk.usage", "system_disk_usage_bytes", ("service",)),
)
