"""Command-line jobs, for ``spark-submit`` or ``python -m``."""
