"""Tables, dashboard frames and jobs built from the operators."""
