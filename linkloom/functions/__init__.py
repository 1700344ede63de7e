"""Column functions: text normal forms and similarities."""
