"""Reports, analyses, models and composed pipelines."""
