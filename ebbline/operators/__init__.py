"""DataFrame operators: projection, netting, scenarios, history, model, quality."""
