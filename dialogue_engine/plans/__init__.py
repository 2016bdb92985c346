"""The four paths through the operators: prepare, evaluate, report, respond."""
