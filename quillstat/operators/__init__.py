"""Table operators the plans are made of: joins, ranking, unions, generators."""
