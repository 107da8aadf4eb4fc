"""Ready models built from the operators, one module per reference query family."""
