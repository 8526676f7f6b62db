"""Column builders: one expression each, evaluated inside whole-stage codegen."""
