"""DataFrame operators on tables of episodes and steps."""
