"""Tables of the product: star schema, marts, features, dashboards, models."""
