SELECT c.numped, c.codcli, c.data FROM pcpedc c
WHERE NOT EXISTS (SELECT 1 FROM pcpedi i WHERE i.numped = c.numped)
