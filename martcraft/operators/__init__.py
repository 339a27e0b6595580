"""Multi-step DataFrame patterns shared by the plans."""
