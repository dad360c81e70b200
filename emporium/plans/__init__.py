"""Plans: the model graph, the check suite and the registered queries."""
