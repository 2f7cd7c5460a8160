"""Jobs composed of operators: silver tables, gold star schema, measures, suites."""
