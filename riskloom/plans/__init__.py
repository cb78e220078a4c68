"""Jobs that chain operators: training, evaluation, scoring, drift."""
