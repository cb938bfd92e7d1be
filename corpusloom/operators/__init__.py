"""corpusloom.operators"""
