"""taxaframe.plans"""
