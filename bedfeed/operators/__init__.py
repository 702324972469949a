"""Table operators over feeds, messages, observations, locations and patients."""
