"""DataFrame operators: relational helpers, routes, graph, metrics, models, recommender."""
