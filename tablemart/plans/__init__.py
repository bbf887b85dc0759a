"""Table plans: how the published tables follow from the raw ones."""
