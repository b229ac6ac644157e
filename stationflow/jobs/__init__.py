"""Job entry points: the only place with actions, console output and triggers."""
