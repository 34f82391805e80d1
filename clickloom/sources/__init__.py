"""Inputs: the action log, its dimensions, and the ad click log."""
