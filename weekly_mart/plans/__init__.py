"""Plans: the pipeline over all layers, the reports and the report data sets."""
