"""Production costing over time entries, inventory movements, labour cost and downtime.

Columns of a time entry
    row_id, order_id, op_code, op_text, centre, centre_code, method, reference, day, period,
    hours, base_hours, abs_base_hours, qty_done, qty_rejected, base_qty, qty_scrap
added by classification
    process, process_rank, parent_process, parent_rank, second_level, prefix12, specific_process,
    op_class, group_id, mount_order, cost_centre
Columns of a movement
    order_id, doc, reference, day, parent_process, op_text, movement_class, movement_type,
    doc_type, unit, kg
"""
