"""The model layers (staging, dimensions, fact, mart), measures, reports and the pipeline."""
