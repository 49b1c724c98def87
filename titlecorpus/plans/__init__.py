"""End-to-end plans: corpus build, train / evaluate, and the registered queries."""
