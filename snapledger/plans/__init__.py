"""Models, reports, declared checks and the batch job built from the operators."""
