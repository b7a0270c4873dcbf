from .models import register_views, run_models, run_models_on, stage_landing, workspace

__all__ = ["register_views", "run_models", "run_models_on", "stage_landing", "workspace"]
