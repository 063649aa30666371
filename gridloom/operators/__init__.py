"""DataFrame → DataFrame operators on cell-form gridded fields."""
